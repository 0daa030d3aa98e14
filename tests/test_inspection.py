"""Operators that had no test: importances, dropped features, Q-Q points, search and resampling of trained models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark.operators import models as M
from credspark.operators import profile as PR
from credspark.operators import resample as RS
from credspark.operators import stattests as ST
from credspark.operators import tuning as TU


class Scores:
    """A fitted model in the tests' sense: a given linear score."""

    def __init__(self, **weights):
        self.weights = weights

    def transform(self, df):
        return M.linear_score(df, self.weights)


@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(v + 0.3 * e > 0), float(v), float(z)) for i, (v, e, z) in
            enumerate(zip(rng.standard_normal(400), rng.standard_normal(400), rng.standard_normal(400)))]
    return spark.createDataFrame(rows, "row_id long, class int, x double, z double")


def test_permutation_importance_of_a_linear_score(signal):
    got = {r["feature"]: r for r in TU.permutation_importance(Scores(x=2.0), signal, ["x", "z"], repeats=4).collect()}
    assert got["x"]["importance_mean"] > 0.3 and abs(got["z"]["importance_mean"]) < 1e-9
    assert got["x"]["repeats"] == 4


def test_suggest_drops(spark):
    rng = np.random.default_rng(6)
    a = rng.standard_normal(300)
    rows = [(float(v), float(0.5 * v + 0.01 * e), float(w)) for v, e, w in
            zip(a, rng.standard_normal(300), rng.standard_normal(300))]
    got = {r["feature"]: r["reasons"] for r in
           ST.suggest_drops(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got == {"a": ["vif"], "b": ["correlation", "vif"]}      # b has the lower deviation of the pair


def test_qq_points_of_a_line(spark):
    from credspark.functions.distributions import norm_ppf

    n = 50
    p = [(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)]
    p[0], p[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    df = spark.createDataFrame([(3.0 + 2.0 * float(norm_ppf(q)),) for q in p], "v double")
    _, fit = PR.qq_points(df, "v")
    r = fit.first()
    assert r["slope"] == pytest.approx(2.0, abs=1e-6) and r["intercept"] == pytest.approx(3.0, abs=1e-6)


def test_coefficient_rank_is_emitted(spark):
    class Stage:
        class coefficients:  # noqa: N801
            @staticmethod
            def toArray():
                return np.array([0.5, -2.0, 1.0])

        def feature_columns(self):
            return ["a", "b", "c"]

    class Fitted:
        stages = [Stage()]

    rows = M.coefficient_ranking(Fitted(), spark).collect()
    assert [(r["feature"], r["rank"]) for r in rows] == [("b", 1), ("c", 2), ("a", 3)]


def test_svm_smote_balances(spark):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(9)
    rows = [(i, int(i >= 90), (rng.standard_normal(2) + (1.2 if i >= 90 else 0.0)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, class int, x array<double>") \
        .select("row_id", "class", array_to_vector("x").alias("features"))
    out = RS.svm_smote(df, k=3, m=5)
    n = {(r["class"], r["synthetic"]): r["count"] for r in out.groupBy("class", "synthetic").count().collect()}
    assert n[0, 0] == 90 and n[1, 0] == 30 and 0 < n[1, 1] <= 60 and (0, 1) not in n
    three = df.withColumn("class", (F.col("row_id") % 3).cast("int"))
    with pytest.raises(ValueError):
        RS.smote(three)


def test_chi2_expected_has_every_cell(spark):
    df = spark.createDataFrame([("A", "X")] * 3 + [("A", "Y")] + [("B", "X")] * 2, "a string, b string")
    got = {(r["a"], r["b"]): (r["observed"], r["expected"]) for r in ST.chi2_expected(df, "a", "b").collect()}
    assert got[("B", "Y")] == (0, pytest.approx(2 / 6)) and got[("A", "X")] == (3, pytest.approx(20 / 6))


def test_compare_groups_takes_each_branch(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], float(i * i % 17)) for i in range(60)],
                               "row_id long, g string, v double")
    two = df.filter("g <> 'c'")
    names = [ST.compare_groups(x, "g", "v", parametric=p).first()["test_name"] for x in (two, df) for p in (True, False)]
    assert names == ["Independent t-test", "Mann-Whitney U", "One-way ANOVA", "Kruskal-Wallis H"]


def test_tails_against_known_values():
    from credspark.functions import distributions as D

    assert D.betainc(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert 2 * D.t_sf(2.0, 10) == pytest.approx(0.07338803477, abs=1e-10)
    assert D.chi2_sf(10, 4) == pytest.approx(0.0404276820, abs=1e-9)
    assert D.t_sf(1.96, 1e6) == pytest.approx(0.5 * math.erfc(1.96 / math.sqrt(2)), rel=1e-4)
    assert D.gammaincc(5, 5.999999) == pytest.approx(D.gammaincc(5, 6.000001), rel=1e-5)
    assert D.gammaincc(1, 3.0) == pytest.approx(math.exp(-3.0), rel=1e-12)
    assert D.betainc(0.5, 0.5, 0.25) == pytest.approx(1 / 3, rel=1e-10)
