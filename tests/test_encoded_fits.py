"""Regressions that share their passes over coded rows give what each gives on its own encoded rows."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import encoded_fits as EF
from credspark.operators import models as M
from credspark.operators import tuning as TU
from credspark.operators.evaluate import roc_auc
from credspark.operators.pipelines import build_baseline, build_pipeline
from credspark.operators.splits import kfold_assign
from credspark.plans.common import apps, train_side


@pytest.fixture(scope="module")
def train(spark, sf):
    # a level of one row, one that is in one part only, and missing ones
    rid, label = F.col("row_id"), F.col("purpose")
    rows = train_side(apps(spark, sf)).drop("savings_amount").withColumn("part", (rid % 3).cast("int"))
    once = rows.agg(F.min("row_id")).first()[0]
    return rows.withColumn("purpose", F.when(rid == once, "only here").when((rid % 33 == 3), "first part")
                           .when(rid % 17 == 2, None).otherwise(label)).cache()


def rows_of(x, parts):
    some = [r for r in x.table.collect() if parts[r["part"]]]
    n = len(x.cats)
    out = np.zeros((len(some), x.width))
    for i, r in enumerate(some):
        for c in range(n):
            out[i, x.offsets[c] + r[2 + c]] = 1
        out[i, x.offsets[-1]:-1] = (np.array(r[2 + n:]) - x.centres[:, 0]) / x.centres[:, 1]
    out[:, -1] = 1
    return out


@pytest.mark.parametrize("kind", ["lrc", "rfc", "svc", None])
def test_encodings_equal_the_encoders(train, kind):
    rows = train.drop("part")
    pipeline = build_pipeline(kind) if kind else build_baseline(rows)
    x = EF.code_rows(pipeline, train, 3)
    learn, other = np.array([True, True, False]), np.array([False, False, True])
    t = EF.encoding(x, learn)
    model = pipeline.fit(rows.filter(F.col("row_id") % 3 < 2))
    for parts, side in ((learn, rows.filter(F.col("row_id") % 3 < 2)), (other, rows.filter(F.col("row_id") % 3 == 2))):
        want = np.array([r[0] for r in model.transform(side).select(vector_to_array("features")).collect()])
        got = (rows_of(x, parts) @ t)[:, :-1]
        assert got.shape == want.shape
        assert np.allclose(np.sort(got, axis=0), np.sort(want, axis=0), atol=1e-9)
        assert np.allclose(sorted(map(tuple, got.round(6))), sorted(map(tuple, want.round(6))), atol=1e-5)


def test_fits_equal_single_fits_with_and_without_shared_derivatives(train, monkeypatch):
    x = EF.code_rows(build_pipeline("lrc"), train, 3)
    cells = np.array([[True, True, False], [True, False, True], [True, True, True], [True, True, False]])
    maps = [EF.encoding(x, c) for c in cells]
    weights = cells[:, :, None] * np.array([[1, 1], [1, 1], [1, 1], [2.0, 0.5]])[:, None]
    regs = [1e-2, 1e-3, 1e-2, 1e-2]
    fitted = EF.fit(x, maps, regs, weights)
    monkeypatch.setattr(EF, "SLOW", 0.0)            # each takes second derivatives of its own at once
    monkeypatch.setattr(EF, "SUM_BYTES", 1)         # and is fitted alone
    assert np.allclose(fitted, EF.fit(x, maps, regs, weights), atol=1e-3)
    for c, t, reg, w, got in zip(cells, maps, regs, weights, fitted):
        v = rows_of(x, c) @ t
        y = np.array([r["y"] for r in x.table.collect() if c[r["part"]]])
        wy = w[0, y]
        z = rows_of(x, c) @ got
        beta = np.linalg.lstsq(t, got, rcond=None)[0]       # over the encoded columns, the intercept last
        gradient = v.T @ (wy * (1 / (1 + np.exp(-z)) - y)) / wy.sum() + reg * np.append(beta[:-1], 0)
        assert np.abs(gradient).max() < 1e-4


def test_scores_by_ranges_equal_plain_aucs(spark, train, monkeypatch):
    x = EF.code_rows(build_pipeline("lrc"), train, 3)
    rng = np.random.default_rng(0)
    coefficients = rng.normal(size=(2, x.width)).round(1) * (np.arange(x.width) < 12)       # many ties
    sides = np.array([[0, 1, -1], [1, 0, 0]])
    monkeypatch.setattr(EF, "GROUP_ROWS", 50)
    monkeypatch.setattr(EF, "HELD_SCORES", 100)
    got = EF.score(x, coefficients, sides)
    rows = x.table.collect()
    for k in range(2):
        for s in range(2):
            parts = sides[k] == s
            p = 1 / (1 + np.exp(-rows_of(x, parts) @ coefficients[k]))
            y = [r["y"] for r in rows if parts[r["part"]]]
            df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "proba double, class int")
            assert got[k, s] == pytest.approx(roc_auc(df, score="proba").first()["roc_auc"], abs=1e-3)


def test_a_learning_curve_of_regressions_shares_its_passes(train, monkeypatch):
    rows = train.drop("part")
    single = []
    fit = M.LogisticRegression.fit
    monkeypatch.setattr(M.LogisticRegression, "fit", lambda self, x, *a: single.append(1) or fit(self, x, *a))
    got = {(r["train_size"], r["fold"]): r for r in
           TU.learning_scores(rows, M.LogisticFit(), [0.4, 1.0], 3).collect()}
    assert not single and len(got) == 6
    want = TU.learning_scores(rows, M.train_logistic, [0.4, 1.0], 3).collect()
    for r in want:
        for side in ("train_auc", "val_auc"):
            assert got[r["train_size"], r["fold"]][side] == pytest.approx(r[side], abs=3e-3)
    gain = TU.feature_gain(rows, M.LogisticFit(), M.LogisticFit(None), [1.0], 3).collect()
    assert len(single) == 6 and len(gain) == 1 and 0.3 < gain[0]["auc_baseline"] < 1


def test_a_search_of_regressions_encodes_no_fold(train, monkeypatch, tmp_path):
    rows = train.drop("part")
    encoded = []
    matrices = TU.fold_matrices
    monkeypatch.setattr(TU, "fold_matrices", lambda *a: encoded.append(1) or matrices(*a))
    trials, best = TU.tune_search(rows, "lrc", n_trials=3, folds=3)
    assert not encoded
    got = {r["trial"]: r["score"] for r in trials.collect()}
    monkeypatch.setattr(TU, "_shared_search", lambda *a: None)
    other, _ = TU.tune_search(rows, "lrc", n_trials=3, folds=3)
    assert encoded and got == pytest.approx({r["trial"]: r["score"] for r in other.collect()}, abs=1e-4)
    # the last fit is on all rows and can be kept as any other model
    best.write().overwrite().save(str(tmp_path / "model"))
    draw = TU.sample_space(K.LRC_SPACE, 3, 8)[max(got, key=lambda k: (got[k], -k))]
    single = M.train_logistic(rows, C=draw["C"], class_weight=draw["class_weight"])
    score = lambda m: np.array([r["proba"] for r in m.transform(rows).orderBy("row_id").collect()])
    kept = M.PipelineModel.load(str(tmp_path / "model"))
    assert np.array_equal(score(best), score(kept)) and np.abs(score(best) - score(single)).max() < 0.02


def test_rows_that_cannot_be_coded_are_fitted_one_by_one(train, monkeypatch):
    rows = kfold_assign(train.drop("part"), 3, name="part")
    gaps = rows.withColumn("credit_amount", F.when(F.col("row_id") % 5 > 0, F.col("credit_amount")))
    assert EF.code_rows(build_pipeline("lrc"), gaps, 3) is None         # a number that is missing
    monkeypatch.setattr(EF, "MAP_LEVELS", 3)
    assert EF.code_rows(build_pipeline("lrc"), rows, 3) is None         # a category with more levels
    got = TU.learning_scores(train.drop("part"), M.LogisticFit(), [1.0], 2).collect()
    assert len(got) == 2 and all(0.5 < r["train_auc"] < 1 for r in got)
    assert K.TARGET in train.columns
