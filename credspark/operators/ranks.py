"""Distributed ordered statistics: running totals, average ranks, row numbers.

A window ordered over *all* rows of a group runs in one task.  At scale
that group may be the whole table (AUC over 10^11 scores) or a third of
it (a hot class), so ordered work is split by value range instead:

1. aggregate to one row per distinct (group, value) with counts;
2. take a bounded number of cut points of the value (``percentile_approx``
   on the distinct values, collected: at most ``n_buckets`` numbers, fixed
   as literals so every recomputation assigns the same bucket);
3. bucket = number of cut points below the value (a pure function of it);
4. per (group, bucket) totals -> offsets by a window over that small table;
5. running totals inside (group, bucket) -> plus the bucket offset.

Each window partition then holds about (distinct values / n_buckets) rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credspark.session import materialize

ROWS_PER_BUCKET = 2_000_000  # rows of one window task
PROBES = 256  # cut points resolved by the first (and usually only) job


def cut_points(v: DataFrame, order_col: str, n_buckets: int | None,
                rows_per_bucket: int | None = None, minimum: int = 16) -> list[float]:
    """Bounded list of cut points (at most ``n_buckets - 1`` numbers).

    One job counts the rows and estimates 255 quantiles at once; only when
    the rows need more than 256 buckets is a second, finer job run."""
    x = F.col(order_col).cast("double")
    probs = [i / PROBES for i in range(1, PROBES)]
    row = v.agg(F.count(F.lit(1)).alias("n"),
                F.percentile_approx(x, probs, 10000).alias("q")).first()
    if n_buckets is None:
        n = row["n"] or 0
        n_buckets = int(max(minimum, math.ceil(n / (rows_per_bucket or ROWS_PER_BUCKET))))
    if n_buckets <= 1:
        return []
    if n_buckets <= PROBES:
        step = PROBES / n_buckets
        picks = [row["q"][int(round(i * step)) - 1] for i in range(1, n_buckets)] if row["q"] else []
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        picks = v.agg(F.percentile_approx(x, probs, max(10000, 4 * n_buckets)).alias("q")).first()["q"] or []
    return sorted({float(q) for q in picks if q is not None and not math.isnan(q)})


def count_below(x: Column, cuts: list[float], inclusive: bool = False) -> Column:
    """Number of sorted ``cuts`` below x (or at most x when ``inclusive``), as a
    balanced binary search of CASE expressions: whole-stage codegen keeps it
    JVM-side (a lambda over an array would fall back to interpretation)."""
    xd = x.cast("double")

    def go(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        cond = (xd >= F.lit(float(cuts[mid]))) if inclusive else (xd > F.lit(float(cuts[mid])))
        return F.when(cond, go(mid + 1, hi)).otherwise(go(lo, mid))

    return go(0, len(cuts))


def bucket_expr(x: Column, cuts: list[float]) -> Column:
    return count_below(x, cuts) if cuts else F.lit(0)


def running_totals(v: DataFrame, order_col: str, sum_cols: list[str], group_cols: list[str] | None = None,
                   tie_cols: list[str] | None = None, n_buckets: int | None = None,
                   suffix: str = "_cum", uniform_below: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ascending ``order_col`` (then
    ``tie_cols``) within ``group_cols``.  ``v`` should hold one row per distinct
    ordering key; rows with equal keys would be split arbitrarily.

    Keys that are uniform in [0, uniform_below), as seeded hashes are, need no
    cut points: their bucket is their share of that range, for any number of buckets."""
    group_cols = list(group_cols or [])
    tie_cols = list(tie_cols or [])
    if uniform_below:
        n_buckets = n_buckets or max(16, math.ceil(v.count() / ROWS_PER_BUCKET))
        share = F.col(order_col).cast("double") * F.lit(n_buckets / uniform_below)
        vb = v.withColumn("_bkt", F.least(F.floor(share), F.lit(n_buckets - 1)).cast("int"))
    else:
        vb = v.withColumn("_bkt", bucket_expr(F.col(order_col), cut_points(v, order_col, n_buckets)))
    w = Window.partitionBy(*group_cols, "_bkt").orderBy(order_col, *tie_cols) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = vb.select("*", *[F.sum(c).over(w).alias(f"_r_{c}") for c in sum_cols])
    # bucket totals, a small table; Spark may read the input a second time for it
    totals = runs.groupBy(*group_cols, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wo = (Window.partitionBy(*group_cols).orderBy("_bkt") if group_cols else Window.orderBy("_bkt")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    # ``totals`` has (groups x buckets) rows: small, so the un-partitioned
    # window is over at most n_buckets rows when there is no group.
    offsets = totals.select(*group_cols, "_bkt",
                            *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    if not group_cols:
        offsets = F.broadcast(offsets)  # at most n_buckets rows
    out = runs.join(offsets, on=[*group_cols, "_bkt"], how="inner")
    return out.select(*v.columns, *[(F.col(f"_o_{c}") + F.col(f"_r_{c}")).alias(f"{c}{suffix}") for c in sum_cols])


def value_counts(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
                 label_col: str | None = None, positive=1) -> DataFrame:
    """One row per distinct (group, value): n, and n_pos if a label is given."""
    group_cols = list(group_cols or [])
    aggs = [F.count(F.lit(1)).alias("n")]
    if label_col:
        aggs.append(F.sum(F.when(F.col(label_col) == positive, 1).otherwise(0)).alias("n_pos"))
    return df.filter(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(*aggs)


def distinct_ranks(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
                   label_col: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """Per distinct value: n (and n_pos), ``rank`` = average rank of ties
    (1-based, ascending) within the group.  No join back to rows."""
    v = materialize(value_counts(df, value_col, group_cols, label_col))  # one scan of the rows
    cum = running_totals(v, value_col, ["n"], group_cols, n_buckets=n_buckets)
    return cum.select(*v.columns, (F.col("n_cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias("rank"))


def avg_rank(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
             name: str = "rank", n_buckets: int | None = None) -> DataFrame:
    """Average rank with ties for every row (as ``rank(method='average')``).

    The ranks are computed on distinct values and joined back on the value:
    a shuffle join that AQE splits when one value dominates."""
    group_cols = list(group_cols or [])
    r = distinct_ranks(df, value_col, group_cols, n_buckets=n_buckets) \
        .select(*group_cols, value_col, F.col("rank").alias(name))
    return df.join(r, on=[*group_cols, value_col], how="left")


def row_numbers(df: DataFrame, order_col: str, group_cols: list[str] | None = None,
                tie_cols: list[str] | None = None, name: str = "rn",
                n_buckets: int | None = None, uniform_below: int | None = None) -> DataFrame:
    """Exact 1-based row numbers in (order_col, tie_cols) order within groups,
    without putting a group in one task.  Keys should be (nearly) unique."""
    v = df.withColumn("_one", F.lit(1).cast("bigint"))
    out = running_totals(v, order_col, ["_one"], group_cols, tie_cols=tie_cols, n_buckets=n_buckets,
                         uniform_below=uniform_below)
    return out.withColumnRenamed("_one_cum", name).drop("_one")
