"""Resampling sorts and joins no more than it needs."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from credspark.operators import ranks as RK
from credspark.operators import resample as RS


def test_smote_numbers_ids_without_their_vectors(spark, monkeypatch):
    """Before, the vectors were sorted with the ids, three times."""
    seen = []
    numbers = RK.row_numbers

    def noted(df, *a, **k):
        seen.append(df.columns)
        return numbers(df, *a, **k)

    monkeypatch.setattr(RS, "row_numbers", noted)
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 4 > 0), rng.normal(size=3).tolist()) for i in range(80)]
    df = spark.createDataFrame(rows, "row_id long, class int, x array<double>").select(
        "row_id", "class", array_to_vector("x").alias("features"))
    out = RS.smote(df)
    assert out.filter("synthetic = 1").count() == 40 and out.filter("class = 0").count() == 60
    assert seen and all("x" not in c and "nbr_ids" not in c for c in seen)


def test_equal_vectors_share_a_key(spark):
    rows = [(1, [0.0, float("nan")]), (2, [-0.0, float("nan")]), (3, [0.0, None]), (4, [float("nan"), 0.0])]
    got = {r["i"]: bytes(r["key"]) for r in RS._keyed(spark.createDataFrame(rows, "i int, x array<double>"), "x", ["i"]).collect()}
    assert got[1] == got[2] == got[3] != got[4]
    with pytest.raises(Exception, match="without a vector"):
        RS._keyed(spark.createDataFrame([(1, None)], "i int, x array<double>"), "x", ["i"]).collect()


def test_box_distances_skip_idle_columns():
    rng = np.random.default_rng(1)
    x, low = rng.normal(size=(40, 6)), rng.normal(size=(9, 6))
    high = low + rng.uniform(0, 2, size=low.shape)
    low[:, 2], high[:, 2] = -50, 50         # no row is beyond it
    want = (np.maximum(0, np.maximum(low - x[:, None], x[:, None] - high)) ** 2).sum(axis=2)
    assert np.allclose(RS._box_distance(x, low, high), want)
