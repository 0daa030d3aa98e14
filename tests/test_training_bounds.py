"""What training keeps of its rows, how many tasks a solver's pass takes, and which fits run side by side."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import models as M
from credspark.operators import resample as RS
from credspark.operators import tuning as TU
from credspark.plans.common import apps, train_side


@pytest.fixture(scope="module")
def train(spark, sf):
    return train_side(apps(spark, sf)).cache()


class Given:
    """A model without stages: a score that depends on the row only."""

    def __init__(self, slope=0.01):
        self.slope = slope

    def transform(self, df):
        return df.withColumn("proba", 1 / (1 + F.exp(self.slope * (F.col("duration_months") - 40))))


def test_small_tables_are_few_tasks_for_a_solver_and_large_ones_keep_theirs(spark):
    rows = spark.range(1000).repartition(8)
    assert M.gathered(rows, 1000, 40).rdd.getNumPartitions() == 1
    assert M.gathered(rows, 10 ** 9, 40).rdd.getNumPartitions() == 8
    assert M.at_once(1000, 40, 4) == 4 and M.at_once(10 ** 7, 200, 4) == 1


def test_solvers_get_and_keep_only_the_columns_that_they_read(train, monkeypatch):
    kept, tables = [], {}
    for cls in (M.RandomForestClassifier, M.LogisticRegression, M.LinearSVC):
        monkeypatch.setattr(cls, "fit", lambda self, x, *a, _fit=cls.fit: kept.append(x.columns) or _fit(self, x, *a))
    written = M.written
    monkeypatch.setattr(M, "written", lambda df, tag: tables.setdefault(tag, df.columns) and written(df, tag))
    forest = M.train_forest(train, num_trees=2, max_depth=2)
    assert kept == [[K.TARGET, "features", "weight"]] and forest.stages[-2].getNumTrees == 2
    kept.clear()
    M.train_logistic(train)
    assert kept == [[K.TARGET, "features"]]
    kept.clear()
    svm = M.train_kernel_svm(train, n_components=5, calib_folds=2, max_iter=3)
    assert tables["encoded"] == [K.ROW_ID, K.TARGET, "features"]
    assert kept == [[K.TARGET, "fold", "rff"]] * 3 + [["margin", K.TARGET]]
    assert svm.transform(train).filter("proba is null").count() == 0


def test_resampling_svm_runs_in_few_tasks(spark, monkeypatch):
    tasks = []
    fit = RS.LinearSVC.fit
    monkeypatch.setattr(RS.LinearSVC, "fit", lambda self, x, *a: tasks.append(x.rdd.getNumPartitions()) or fit(self, x, *a))
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 4 > 0), (rng.normal(size=3) + (i % 4 > 0)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, class int, x array<double>").repartition(4)
    out = RS.svm_smote(df.select("row_id", "class", M.array_to_vector("x").alias("features")), k=3, m=5)
    assert tasks == [1]
    assert {r["class"]: r["count"] for r in out.groupBy("class").count().collect()} == {0: 150, 1: 150}


def test_both_curves_of_a_feature_gain_share_folds_and_samples(train, monkeypatch):
    dealt = []
    assign = TU.kfold_assign
    monkeypatch.setattr(TU, "kfold_assign", lambda *a, **kw: dealt.append(1) or assign(*a, **kw))
    gain = TU.feature_gain(train, lambda df: Given(), lambda df: Given(-0.01), [0.5, 1.0], folds=2).collect()
    assert len(dealt) == 1 and [r["train_size"] for r in gain] == [0.5, 1.0]
    for r in gain:      # the second score is the first one turned round
        assert r["auc_engineered"] + r["auc_baseline"] == pytest.approx(1) and r["gain"] > 0


def test_sides_are_the_same_by_one_pass_or_two(train):
    rows = train.withColumn(TU.SIDE, F.when(F.col("row_id") % 3 == 0, "val").otherwise("train"))
    model = M.train_logistic(train)

    class Plain:
        transform = staticmethod(model.transform)

    once, twice = (sorted(map(tuple, TU._with_side(m, rows, [K.ROW_ID, "proba"]).collect())) for m in (model, Plain()))
    assert once == twice and {s for s, *_ in once} == {"train", "val"}


def test_refits_under_several_seeds_run_side_by_side(train):
    meet = threading.Barrier(3, timeout=60)

    def fit(df, seed):
        meet.wait()     # breaks if a refit waits for the one before
        return Given(0.01 * (seed + 1))

    per, summary = TU.seed_stability(train, train, fit, seeds=range(3))
    assert [r["seed"] for r in per.orderBy("seed").collect()] == [0, 1, 2] and summary.count() == 6


def test_models_of_an_ensemble_are_fitted_side_by_side(train, monkeypatch):
    meet = threading.Barrier(3, timeout=60)
    for name in ("train_logistic", "train_forest", "train_kernel_svm"):
        monkeypatch.setattr(M, name, lambda df, _name=name, **kw: meet.wait() >= 0 and _name)
    assert M.train_all(train) == {"lrc": "train_logistic", "rfc": "train_forest", "svc": "train_kernel_svm"}
