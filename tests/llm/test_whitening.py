"""Whitening against plain numpy, and the contour integration by itself."""

import math

import numpy as np
import pytest
from conftest import clashing
from pyspark.sql import functions as F

from credspark.llm import feast as X
from credspark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    rng = np.random.default_rng(1)
    for n, rows in ((64, 500), (10, 30), (1, 5), (120, 900)):
        yield n, rng.normal(size=(rows, n))
    yield 64, rng.normal(size=(500, 64)) * np.logspace(0, -6, 64)
    yield 64, np.repeat(rng.normal(size=(20, 8)), 8, axis=1)     # rank 8
    yield 40, np.vstack([np.eye(40), -np.eye(40)])               # all eigenvalues equal
    yield 12, rng.normal(size=(200, 12)) * np.repeat([5, 5, 1], 4)


@pytest.mark.parametrize("case", range(8))
def test_eigenpairs_and_inertia(case):
    n, rows = list(matrices())[case]
    a = rows.T @ rows / len(rows)
    values, vectors = X.largest(a, 32)
    want = np.linalg.eigvalsh(a)[::-1]
    assert len(values) == min(32, int((want > 1e-11 * want[0]).sum()))
    assert np.allclose(values, want[:len(values)], rtol=1e-9, atol=1e-14 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-9 * want[0]
    for x in (-1.0, want[0] / 3, want[n // 2] + 1e-6 * want[0], 2 * want[0]):
        assert X.Inertia(a)(x) == int((want < x).sum())


def brute(vectors):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    away = n * x.astype(object) - x.astype(object).sum(axis=0)
    centred = away.astype(float) / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-value)[:32]
    return n, (away ** 2).sum(axis=1), value[order], np.trace(centred.T @ centred / n), centred @ vector[:, order] / \
        np.sqrt(value[order])


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40)) / 10).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [(900, None, 0), (901, [None] * 40, 0), (902, [math.nan] * 40, 0), (903, [math.inf] + [0.0] * 39, 0),
           (904, [], 0), (905, [1.0], 0), (906, [0.0] * 39 + [-math.inf], 0), (907, [3e38] * 40, 0)]
    df = clashing(spark.createDataFrame(rows + bad, SCHEMA).repartition(5), "x", "n", "white", "deviation")
    out = W.whiten(df).toPandas().sort_values(["vec_id", "component"])
    n, deviation, value, trace, white = brute(vectors)
    assert len(out) == 300 * 32 and set(out["n"]) == {n}
    assert out["component"].tolist() == list(range(1, 33)) * 300
    assert out["deviation"].tolist() == np.repeat(deviation, 32).tolist()
    got = out["whitened"].to_numpy().reshape(300, 32)
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-7
    assert np.allclose(out["explained"].to_numpy()[:32], value / trace, rtol=1e-9)
    assert out["identity_error"].nunique() == 1 and out["identity_error"][0] < 1e-9
    assert abs(out["identity_error"][0] - np.abs(np.cov(got.T, bias=True) - np.eye(32)).max()) < 1e-12


def test_ties_repeated_rows_and_degenerate_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert W.whiten(make([])).collect() == []
    assert W.whiten(make([(1, [1.0, 2.0], 0)])).collect() == []
    assert W.whiten(make([(i, [1.0, 2.0], 0) for i in range(5)])).collect() == []
    rows = [(1, [0.0, 0.0], 0), (1, [0.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    out = W.whiten(make(rows))
    assert out.count() == 10 and out.filter(F.col("vec_id") == 1).count() == 4
    flat = [(i, [float(i), 2.0 * i, 5.0], 0) for i in range(10)]
    assert W.whiten(make(flat)).select(F.max("component")).first()[0] == 1


def test_deviations_stay_exact_in_large_numbers():
    x, sums = np.array([[10 ** 12, 5], [7, 10 ** 12]]), np.array([10 ** 12 + 7, 10 ** 12 + 5])
    assert W.deviations(x, 2, sums) == [None, None]
    x, sums = np.array([[10 ** 6 + 3, 10 ** 6 - 9]]), np.array([10 ** 9 * 10 ** 6, 10 ** 9 * 10 ** 6])
    assert W.deviations(x, 10 ** 9, sums) == [None]
    assert W.deviations(x, 10 ** 8, sums // 10) == [10 ** 16 * 90]
