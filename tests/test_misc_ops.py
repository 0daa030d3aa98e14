"""Smaller operators: decoding, domains, bins, diagnosis, out-of-fold threshold tuning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark.operators import features as FE
from credspark.operators import tuning as TU


def test_decode_keeps_unmapped_and_recode(spark):
    df = spark.createDataFrame([("A11", "1"), ("A99", "2"), (None, "1")], "checking_account_status string, class string")
    out = FE.target_recode(FE.decode_codes(df)).collect()
    assert [r["checking_account_status"] for r in out] == ["< 0 DM", "A99", None]
    assert [r["class"] for r in out] == [1, 0, 1]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("12",), ("x1",)], "duration_months string")
    with pytest.raises(Exception):
        FE.cast_numeric_strict(df, ["duration_months"]).collect()


def test_bins_right_closed_and_outside_null(spark):
    df = spark.createDataFrame([(2000, 25), (2001, 26), (0, 101), (50000, 100)], "credit_amount int, age_years int")
    out = FE.bin_right_closed(df).collect()
    assert [r["credit_amount_bins"] for r in out] == ["a", "b", None, "e"]
    assert [r["age_group"] for r in out] == ["Young", "Early_Career", None, "Mature"]


def test_quantile_bins_equal_frequency(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    counts = {r["x_q5"]: r["count"] for r in FE.quantile_bins(df, "x", 5).groupBy("x_q5").count().collect()}
    assert counts == {"Q1": 20, "Q2": 20, "Q3": 20, "Q4": 20, "Q5": 20}


def test_validate_domain_counts(spark):
    df = spark.createDataFrame([("yes", 10, "car (new)"), ("maybe", 90, "vacation"), (None, 30, "others")],
                               "foreign_worker string, age_years int, purpose string")
    cats = {"foreign_worker": ["yes", "no"], "purpose": ["car (new)", "others"]}
    out = {r["column_name"]: r["n_invalid"] for r in FE.validate_domain(df, cats, {"age_years": (18, 80)}).collect()}
    assert out == {"foreign_worker": 1, "purpose": 1, "age_years": 2}


def test_learning_diagnosis_rules(spark):
    df = spark.createDataFrame([(0.95, 0.65), (0.74, 0.72), (0.83, 0.80)], "train_auc double, val_auc double")
    d = [r["diagnosis"] for r in TU.learning_diagnosis(df).collect()]
    assert len(d[0]) == 2 and d[0] == ["low_score", "high_variance"]
    assert d[1][0] == "high_bias" and d[2] == ["balanced"]


def test_threshold_cv_brute_force(spark):
    rng = np.random.default_rng(5)
    n = 600
    rows = [(int(f), int(y), float(p)) for f, y, p in
            zip(rng.integers(0, 3, n), rng.integers(0, 2, n), np.round(rng.random(n), 3))]
    df = spark.createDataFrame(rows, "fold int, class int, proba double")
    per, best = TU.tune_threshold_cv(df, 20)
    got = {r["i"]: r["mean_cost"] for r in per.collect()}
    p = np.array([r[2] for r in rows]); y = np.array([r[1] for r in rows]); f = np.array([r[0] for r in rows])
    lo, hi = p.min(), p.max()
    step = (hi - lo) / 19
    cands = [lo + i * step for i in range(19)] + [hi]
    for i, t in enumerate(cands):
        costs = []
        for k in range(3):
            m = f == k
            fp = ((p >= t) & (y == 0) & m).sum()
            fn = ((p < t) & (y == 1) & m).sum()
            costs.append(5 * fp + fn)
        assert got[i] == pytest.approx(np.mean(costs))
    b = best.first()
    assert got[b["i"]] == min(got.values())


def test_grid_auc_matches_direct(spark):
    from credspark.operators import ensemble as EN
    from credspark.operators import evaluate as EV
    rng = np.random.default_rng(2)
    rows = [(int(y), float(a), float(b), float(c)) for y, a, b, c in
            zip(rng.integers(0, 2, 400), rng.random(400), rng.random(400), rng.random(400))]
    df = spark.createDataFrame(rows, "class int, proba_lrc double, proba_rfc double, proba_svc double")
    top = EN.topk_by_cost(EN.weight_grid_search(df), 3)
    aucs = {r["grid_pos"]: r["roc_auc"] for r in EN.grid_auc(df, top).collect()}
    for r in top.collect():
        direct = EV.roc_auc(EN.soft_vote(df, [r["w_lrc"], r["w_rfc"], r["w_svc"]])).first()["roc_auc"]
        assert aucs[r["grid_pos"]] == pytest.approx(direct, abs=1e-9)
    assert F is not None


def test_register_model_never_overwrites(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from credspark.sources import registry as RG

    root, model = str(tmp_path), PipelineModel(stages=[])
    assert [RG.register_model(model, spark, root, "m").first()["version"] for _ in range(2)] == [1, 2]
    broken = tmp_path / "model_versions" / "part-broken.snappy.parquet"
    broken.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        RG.register_model(model, spark, root, "m")
    broken.unlink()
    assert sorted(p.name for p in (tmp_path / "models" / "m").iterdir() if p.name.isdigit()) == ["1", "2"]
    (tmp_path / "models" / "m" / "3").mkdir()      # files of a writer that is gone: passed over, not overwritten
    assert RG.register_model(model, spark, root, "m").first()["version"] == 4


def test_register_model_after_a_crash_and_beside_other_writers(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    from pyspark.ml import PipelineModel

    from credspark.sources import registry as RG

    class Failing:
        def write(self):
            raise RuntimeError("the writer died after its claim")

    root, model = str(tmp_path), PipelineModel(stages=[])
    RG.register_model(model, spark, root, "m")
    with pytest.raises(RuntimeError):
        RG.register_model(Failing(), spark, root, "m")
    assert RG.register_model(model, spark, root, "m").first()["version"] == 3      # 2 is claimed and never listed
    with ThreadPool(4) as pool:
        got = pool.map(lambda _: RG.register_model(model, spark, root, "m").first()["version"], range(6))
    assert len(set(got)) == 6 and min(got) > 3
    listed = sorted(r["version"] for r in RG.model_versions(spark, root).collect())
    assert listed == [1, 3, *sorted(got)]
    assert RG.resolve_model_version(RG.model_versions(spark, root)).first()["version"] == max(got)


def test_two_group_tests_want_two_groups(spark):
    from credspark.operators import stattests as ST

    df = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(30)], "row_id long, g string, v double")
    for test in (ST.ttest_ind, ST.mann_whitney_u):
        for groups in (["a", "b", "c"], ["a"]):
            with pytest.raises(ValueError):
                test(df.filter(F.col("g").isin(groups)), "g", "v")
    two = df.filter("g <> 'c'")
    assert ST.mann_whitney_u(two, "g", "v", id_col=None).first()["u_stat"] == \
        ST.mann_whitney_u(two, "g", "v").first()["u_stat"]


def _neighbours(x, ids, k):
    out = {}
    for i, v in zip(ids, x):
        d = ((v - x) ** 2).sum(axis=1)
        out[i] = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != i][:k]
    return out


@pytest.mark.parametrize("block,pivots", [(17, 256), (5000, 5), (3, 2)])
def test_knn_equals_brute_force(spark, monkeypatch, block, pivots):
    from credspark.operators import resample as RS

    monkeypatch.setattr(RS, "BLOCK_ROWS", block)
    monkeypatch.setattr(RS, "PIVOTS", pivots)
    rng = np.random.default_rng(3)
    for x in (rng.integers(0, 3, (90, 4)).astype(float),            # many ties and equal rows
              np.vstack([np.zeros((40, 3)), rng.normal(size=(60, 3)), 50 + rng.normal(size=(50, 3))])):
        ids = rng.permutation(len(x)) + 5
        df = spark.createDataFrame([(int(i), int(i) % 2, v.tolist()) for i, v in zip(ids, x)],
                                   "row_id long, class int, x array<double>").repartition(5)
        got = {r["row_id"]: r for r in RS.knn(df, df, 6).collect()}
        want = _neighbours(x, ids, 6)
        assert {i: r["nbr_ids"] for i, r in got.items()} == want
        assert all(r["nbr_labels"] == [j % 2 for j in r["nbr_ids"]] for r in got.values())


def test_knn_odd_tables(spark):
    from credspark.operators import resample as RS

    schema = "row_id long, class int, x array<double>, g string"
    empty = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(7, 1, [1.0, 2.0], None)], schema)
    assert RS.knn(empty, empty, 3).count() == 0
    assert RS.knn(one, one, 3).first()["nbr_ids"] == []
    assert RS.knn(one, empty, 3).first()["nbr_ids"] == []
    assert RS.knn(one, one, 3, exclude_self=False).first()["nbr_ids"] == [7]
    same = spark.createDataFrame([(i, 0, [1.0, 1.0], "a") for i in range(50)], schema)
    got = {r["row_id"]: r["nbr_ids"] for r in RS.knn(same, same, 2, group_col="g").collect()}
    assert got == {i: [j for j in range(4) if j != i][:2] for i in range(50)}


def test_knn_visits_few_cells_of_clustered_rows(spark):
    """The plan's point: a query is not copied to every block; rows in tight clusters meet their own cells."""
    from credspark.operators import resample as RS

    rng = np.random.default_rng(1)
    centre = rng.normal(0, 30, (40, 8))
    x = np.repeat(centre, 50, axis=0) + rng.normal(0, 0.5, (2000, 8))
    seen = []
    compare = RS._compare

    def counted(queries, refs, k):
        seen.append(queries.count())
        return compare(queries, refs, k)

    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "row_id long, class int, x array<double>")
    try:
        RS._compare = counted
        RS.knn(df, df, 5).collect()
    finally:
        RS._compare = compare
    assert seen[0] == 2000 and seen[1] < 4 * 2000


def test_shapiro_has_a_row_at_every_size(spark):
    from credspark.operators import stattests as ST

    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(("a", "b")[i % 2], float(v)) for i, v in enumerate(rng.standard_normal(12_000))],
                               "g string, v double")
    rows = ST.normality_shapiro(df, ["v"], group="g").collect()
    assert [r["n"] for r in rows] == [6000, 6000] and all(r["w"] > 0.99 and r["p_extrapolated"] for r in rows)


def test_search_rejects_unknown_models(spark):
    with pytest.raises(ValueError):
        TU.tune_search(spark.range(3), "tree")


def test_a_cluster_must_name_its_folder(monkeypatch):
    from credspark import session as SE

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        SE.checkpoint_dir(Session())
