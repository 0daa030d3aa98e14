"""Search, learning curves, importance and chained scoring run to results that plain loops give too."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import batch_fits as BF
from credspark.operators import models as M
from credspark.operators import resample as RS
from credspark.operators import tuning as TU
from credspark.operators.evaluate import roc_auc
from credspark.operators.splits import kfold_assign
from credspark.plans.common import apps, held_out, train_side


@pytest.fixture(scope="module")
def train(spark, sf):
    return train_side(apps(spark, sf)).cache()


def auc_of(model, df):
    return roc_auc(model.transform(df).select(K.TARGET, "proba"), score="proba").first()["roc_auc"]


def test_logistic_many_equals_single_fits(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)) * [1, 2, 0.1, 5, 1]
    y = (x @ [1, -0.5, 3, 0.1, 0] + rng.normal(size=400) > 0.7).astype(int)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "x array<double>, class int").repartition(6)
    df = df.cache()
    regs, weights = [1.0, 0.01, 1e-4, 0.01], [None, {0: 2.0, 1: 0.5}, None, None]
    got = BF.logistic_many(df, regs, weights)
    monkeypatch.setattr(BF, "SUM_BYTES", 1)     # one model at a time
    monkeypatch.setattr(BF, "DIRECT", 2)        # sums through groups of tasks
    assert np.allclose(got, BF.logistic_many(df, regs, weights), atol=1e-8)
    for coefficients, reg, w in zip(got, regs, weights):
        lr = LogisticRegression(featuresCol="features", labelCol="class", regParam=reg, standardization=False,
                                maxIter=500, tol=1e-12, weightCol="w")
        one = lr.fit(df.select("class", array_to_vector("x").alias("features"),
                               F.when(F.col("class") == 1, (w or {}).get(1, 1.0)).otherwise((w or {}).get(0, 1.0)).alias("w")))
        assert np.allclose(coefficients, [*one.coefficients.toArray(), one.intercept], atol=1e-4)


def test_search_lrc_equals_a_loop_over_folds(train):
    trials, best = TU.tune_search(train, "lrc", n_trials=3, folds=3)
    rows = {r["trial"]: r for r in trials.collect()}
    assert sorted(rows) == [0, 1, 2] and all(r["n_folds"] == 3 for r in rows.values())
    folds = kfold_assign(train, 3, 8).cache()
    p = TU.sample_space(K.LRC_SPACE, 3, 8)[1]
    aucs = []
    for f in range(3):
        m = M.train_logistic(folds.filter(F.col("fold") != f).drop("fold"), C=p["C"], class_weight=p["class_weight"])
        aucs.append(auc_of(m, folds.filter(F.col("fold") == f).drop("fold")))
    assert rows[1]["score"] == pytest.approx(np.mean(aucs), abs=2e-3)
    assert best.transform(train).filter("proba between 0 and 1").count() == train.count()


@pytest.mark.parametrize("model,space", [
    ("rfc", {**K.RFC_SPACE, "n_estimators": ("int", 5, 8), "max_depth": ("int", 2, 3)}),
    ("svc", K.SVC_SPACE),
])
def test_search_by_halving_runs_to_a_result(train, model, space):
    trials, best = TU.tune_search(train, model, space, n_trials=6, folds=3)
    rows = trials.collect()
    assert sorted(r["n_folds"] for r in rows) == [1, 1, 3, 3, 3, 3]     # the better half of the first fold goes on
    assert all(0.3 < r["score"] < 1 for r in rows)
    assert best.transform(train).filter("proba between 0 and 1").count() == train.count()


def test_search_resamples_inside_folds(train):
    seen = []

    def resample(df):
        seen.append({r["row_id"] for r in df.select("row_id").collect()})
        return RS.smote(df)

    trials, _ = TU.tune_search(train, "lrc", n_trials=2, folds=2, resample=resample)
    assert trials.count() == 2 and len(seen) == 3      # each fold's other rows, and all rows for the last fit
    everything = {r["row_id"] for r in train.select("row_id").collect()}
    assert sorted(map(len, seen))[-1] == len(everything) and seen[0] | seen[1] == everything


def test_learning_curve_cell_and_feature_gain(train):
    scores = {(r["train_size"], r["fold"]): r for r in TU.learning_scores(train, M.train_logistic, [0.3, 1.0], 2, 8)
              .collect()}
    assert sorted(scores) == [(0.3, 0), (0.3, 1), (1.0, 0), (1.0, 1)]
    df = kfold_assign(train, 2, 8)
    rest, val = df.filter("fold != 1").drop("fold"), df.filter("fold = 1").drop("fold")
    m = M.train_logistic(rest)
    assert scores[1.0, 1]["val_auc"] == pytest.approx(auc_of(m, val), abs=1e-3)
    assert scores[1.0, 1]["train_auc"] == pytest.approx(auc_of(m, rest), abs=1e-3)
    curve = TU.learning_curve(train, M.train_logistic, [0.5, 1.0], folds=2).collect()
    assert [r["train_size"] for r in curve] == [0.5, 1.0] and all(len(r["diagnosis"]) >= 0 for r in curve)
    gain = TU.feature_gain(train, M.train_logistic, M.train_logistic, [1.0], folds=2).collect()
    assert [(r["train_size"], r["gain"]) for r in gain] == [(1.0, 0.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 100, 1000])
def test_shuffled_positions_are_a_bijection(spark, n):
    rows = spark.range(n).select("id", F.explode(F.array(*map(F.lit, range(3)))).alias("rep"))
    got = rows.select("id", "rep", TU.shuffled_position(F.col("id"), n, F.col("rep"), 42).alias("j")).collect()
    for rep in range(3):
        mine = [r["j"] for r in sorted(got, key=lambda r: r["id"]) if r["rep"] == rep]
        assert sorted(mine) == list(range(n))
        if n >= 100:    # no order is left: rank correlation near 0, few fixed points
            assert abs(np.corrcoef(mine, range(n))[0, 1]) < 4 / math.sqrt(n) and sum(a == b for a, b in enumerate(mine)) < 8


def test_permutation_importance_of_a_given_score(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(a + 0.3 * e > 0), float(a), float(b)) for i, (a, b, e) in enumerate(rng.normal(size=(800, 3)))]
    df = spark.createDataFrame(rows, "row_id long, class int, a double, b double")
    score = lambda d: M.linear_score(d, {"a": 2.0, "b": 0.0})
    out = {r["feature"]: r for r in TU.permutation_importance(score, df, ["a", "b"], repeats=4).collect()}
    assert out["a"]["importance_mean"] > 0.4 and out["b"]["importance_mean"] == 0 and out["a"]["repeats"] == 4


def test_models_are_chained_without_a_join(spark, sf, train):
    te = held_out(apps(spark, sf)).select("*")
    models = {"lrc": M.train_logistic(train), "rfc": M.train_forest(train, num_trees=5, max_depth=3)}
    rows = spark.createDataFrame(te.collect(), te.schema)       # a relation without joins of its own
    out = M.score_models(models, rows)
    assert out.columns == ["row_id", "class", "proba_lrc", "proba_rfc"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["row_id"]: r for r in out.collect()}
    for name, m in models.items():
        for r in m.transform(te).select("row_id", "proba").collect():
            assert got[r["row_id"]][f"proba_{name}"] == pytest.approx(r["proba"], abs=1e-12)
    assert vector_to_array is not None
