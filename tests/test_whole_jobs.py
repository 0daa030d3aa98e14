"""Bounds on what one task holds, and jobs that once ran on a part of their rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark import session as SE
from credspark.operators import resample as RS
from credspark.plans.common import apps, held_out, sides, train_side


@pytest.mark.parametrize("rows", [7, 64])
def test_knn_tasks_hold_bounded_parts(spark, monkeypatch, rows):
    """Queries that all visit one block are dealt to parts; the neighbours stay those of a plain loop."""
    met = []
    monkeypatch.setattr(RS, "QUERY_ROWS", rows)
    monkeypatch.setattr(RS, "LEAF_ROWS", 20)
    dealt = RS._dealt

    def counted(queries, others, keys, work, schema):
        met.append((keys, queries.count()))
        return dealt(queries, others, keys, work, schema)

    monkeypatch.setattr(RS, "_dealt", counted)
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(150, 5)), np.zeros((10, 5)), rng.integers(0, 2, (60, 5))])
    df = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "row_id long, class int, x array<double>")
    got = {r["row_id"]: r["nbr_ids"] for r in RS.knn(df, df, 4).collect()}
    for i, v in enumerate(x):
        d = np.zeros(len(x))
        for c in range(5):
            d += (v[c] - x[:, c]) ** 2
        assert got[i] == [int(j) for j in np.lexsort((np.arange(len(x)), d)) if j != i][:4]
    assert any(n > rows for _, n in met)


def test_tree_gives_every_row_a_leaf():
    x = np.random.default_rng(1).normal(size=(500, 3)).round(1)
    tree = RS.Tree(x[::3], 16)
    leaf = tree.leaf(x)
    assert tree.leaves <= 16 and leaf.min() >= 0 and leaf.max() < tree.leaves and len(np.unique(leaf)) > 8
    assert RS.Tree(np.ones((9, 3)), 16).leaves == 1


def test_sides_are_written_once_and_spread(spark, sf):
    tr, te = sides(spark, sf)
    for got, want in ((tr, train_side(apps(spark, sf))), (te, held_out(apps(spark, sf)))):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    one = spark.range(100).coalesce(1)
    assert SE.spread(one).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 64)
    assert SE.spread(many).rdd.getNumPartitions() == 64
    assert SE.spread(one).agg(F.sum("id")).first()[0] == 4950
