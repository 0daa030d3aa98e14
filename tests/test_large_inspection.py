"""Permutation importance counts its scores where they are made."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark.operators import evaluate as EV
from credspark.operators import tuning as TU


@pytest.mark.parametrize("cuts", [[], [0.25, 0.5], [0.1, 0.5, 0.5001, 0.9, 3.0]])
def test_many_aucs_are_those_of_the_ranks(spark, monkeypatch, cuts):
    monkeypatch.setattr(TU, "COUNTED_ROWS", 50)
    rng = np.random.default_rng(5)
    rows = [(int(g), int(y), float(np.round(v, 2))) for g, y, v in
            zip(rng.integers(0, 4, 900), rng.integers(0, 2, 900), rng.uniform(size=900))]
    rows += [(0, 1, None), (1, None, 0.5), (2, 0, float("nan")), (2, 1, float("nan")), (7, 1, 0.5), (1, 0, -0.0), (1, 1, 0.0)]
    df = spark.createDataFrame(rows, "g int, class int, proba double").repartition(5)
    want = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, score="proba", group_cols=["g"]).collect()}
    assert {r["g"]: r["roc_auc"] for r in TU.many_aucs(df, "g", cuts).collect()} == want


@pytest.mark.parametrize("n", [1, 2, 50, 1000])
def test_positions_of_many_rows_are_the_shuffled_ones(spark, n):
    """Before, each position took 32 interpreted steps."""
    rows = spark.range(n).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("rep"))
    both = rows.select(TU.shuffled_position(F.col("i"), n, F.col("rep"), 42).alias("a"), TU._positions(n, 42)("i", "rep").alias("b"))
    assert both.filter("a <> b").count() == 0 and both.count() == 3 * n
