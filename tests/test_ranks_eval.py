"""Distributed ranks, AUC, AP and sweeps against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from credspark.operators import ensemble as EN
from credspark.operators import evaluate as EV
from credspark.operators import ranks as RK


def _data(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 50, n).astype(float)          # many ties
    g = rng.integers(0, 3, n)
    y = (rng.random(n) < 0.3 + 0.01 * x).astype(int)
    s = np.round(rng.random(n), 2)                      # scores with ties
    pdf = pd.DataFrame({"row_id": np.arange(n), "x": x, "g": g, "class": y, "s": s})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_avg_rank_matches_pandas(spark, buckets):
    pdf, df = _data(spark)
    out = RK.avg_rank(df, "x", n_buckets=buckets).toPandas().sort_values("row_id")
    want = pdf.sort_values("row_id")["x"].rank(method="average").to_numpy()
    assert np.allclose(out["rank"].to_numpy(), want)
    grp = RK.avg_rank(df, "x", ["g"], n_buckets=buckets).toPandas().sort_values("row_id")
    want_g = pdf.sort_values("row_id").groupby("g")["x"].rank(method="average").to_numpy()
    assert np.allclose(grp["rank"].to_numpy(), want_g)


def test_row_numbers_exact(spark):
    pdf, df = _data(spark)
    out = RK.row_numbers(df, "x", ["g"], tie_cols=["row_id"], n_buckets=7).toPandas()
    want = pdf.sort_values(["g", "x", "row_id"]).groupby("g").cumcount() + 1
    m = out.set_index("row_id")["rn"].sort_index()
    assert (m.to_numpy() == want.sort_index().to_numpy()).all()


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def test_auc_exact_and_invariances(spark):
    pdf, df = _data(spark)
    want = _auc_brute(pdf["class"].to_numpy(), pdf["s"].to_numpy())
    assert EV.roc_auc(df, score="s").first()["roc_auc"] == pytest.approx(want, abs=1e-6)
    mono = df.withColumn("s", F.exp(F.col("s") * 3))
    assert EV.roc_auc(mono, score="s").first()["roc_auc"] == pytest.approx(want, abs=1e-6)
    flip = df.withColumn("s", -F.col("s"))
    assert EV.roc_auc(flip, score="s").first()["roc_auc"] == pytest.approx(1 - want, abs=1e-6)


def test_average_precision_step_form(spark):
    pdf, df = _data(spark)
    y, s = pdf["class"].to_numpy(), pdf["s"].to_numpy()
    ap = 0.0
    for t in np.unique(s):
        sel = s >= t
        prec = y[sel].sum() / sel.sum()
        ap += prec * y[s == t].sum() / y.sum()
    assert EV.average_precision(df, score="s").first()["average_precision"] == pytest.approx(ap, abs=1e-6)


def test_threshold_sweep_equals_cost_metric(spark):
    pdf, df = _data(spark)
    sweep = {round(r["threshold"], 2): r for r in
             EN.threshold_sweep(df.withColumnRenamed("s", "ensemble_proba")).collect()}
    for i in (20, 37, 50, 63, 80):
        t = i / 100
        pred = df.withColumn("ensemble_pred", (F.col("s") >= F.lit(t)).cast("int"))
        c = EV.cost_metric(pred).first()
        assert sweep[t]["cost"] == c["total_cost"] and sweep[t]["avg_cost"] == c["avg_cost"]


def test_weight_grid_matches_direct(spark):
    pdf, df = _data(spark)
    d = df.select("class", F.col("s").alias("proba_lrc"), (F.col("x") / 50).alias("proba_rfc"),
                  (1 - F.col("s")).alias("proba_svc"))
    grid = {r["grid_pos"]: r for r in EN.weight_grid_search(d).collect()}
    assert len(grid) == 216
    for pos in (0, 77, 215):
        r = grid[pos]
        p = EN.predict_threshold(EN.soft_vote(d, [r["w_lrc"], r["w_rfc"], r["w_svc"]]), 0.5)
        assert EV.cost_metric(p).first()["total_cost"] == r["cost"]
