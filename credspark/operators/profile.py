"""Profiles and descriptive aggregates.

Many columns are profiled at once: the table is unpivoted to
(variable, value) and reduced in ONE pass to per-(variable, value) counts
(partial aggregation map-side), materialized in the shared checkpoint
folder.  Everything else reads that table: moments in two passes over the
distinct values with the small-sample corrections pandas applies, distinct
counts and mode, and exact quantiles through the bucketed running totals of
``ranks`` -- never a whole group in one task, never a second scan of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.distributions import with_normal_quantile
from credspark.operators.ranks import row_numbers, running_totals
from credspark.session import materialize

R = 6


def long_numeric(df: DataFrame, columns: list[str], var: str = "variable", val: str = "value") -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, var, val)


def long_text(df: DataFrame, columns: list[str], var: str = "variable", val: str = "value") -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, var, val)


def exact_quantiles(long: DataFrame, probs: list[float], group_cols: list[str], val: str = "value",
                    names: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / DuckDB ``quantile_cont``)
    per group, from value counts and distributed cumulative counts."""
    vc = materialize(long.filter(F.col(val).isNotNull()).groupBy(*group_cols, val)
                     .agg(F.count(F.lit(1)).alias("n")))  # one scan of the rows
    return quantiles_from_counts(vc, probs, group_cols, val, names)


def quantiles_from_counts(vc: DataFrame, probs: list[float], group_cols: list[str], val: str = "value",
                          names: list[str] | None = None) -> DataFrame:
    """The same quantiles from one row per distinct (group, value) with its count ``n``."""
    names = names or [f"q{p}" for p in probs]
    cum = running_totals(vc, val, ["n"], group_cols)
    tot = vc.groupBy(*group_cols).agg(F.sum("n").alias("_N"))
    j = cum.join(tot, on=group_cols, how="inner") if group_cols else cum.crossJoin(F.broadcast(tot))  # one row
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("_N") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.min(F.when(F.col("n_cum") > lo, F.col(val))).alias(f"_lo_{name}"),
                 F.min(F.when(F.col("n_cum") > hi, F.col(val))).alias(f"_hi_{name}"),
                 F.max(h - lo).alias(f"_f_{name}")]
    g = j.groupBy(*group_cols).agg(*aggs)
    return g.select(*group_cols, *[
        (F.col(f"_lo_{n}") + F.col(f"_f_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n) for n in names])


def _mode_from_counts(vc: DataFrame, group_cols: list[str], val: str = "value") -> DataFrame:
    """Most frequent value per group, smallest value on ties, with its count."""
    best = F.min_by(F.struct(F.col(val).alias("v"), F.col("n").alias("c")), F.struct(-F.col("n"), F.col(val)))
    return vc.groupBy(*group_cols).agg(best.alias("_m")).select(
        *group_cols, F.col("_m.v").alias("mode"), F.col("_m.c").alias("mode_count"))


def profile_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, missing, missing_pct, unique, mean, median, mode, std, variance,
    min, max, range, iqr, skewness, kurtosis (bias-corrected, as pandas), cv."""
    # ONE pass over the rows: (variable, value) counts, NULL included, kept in
    # the shared checkpoint folder; every statistic below reads only this table.
    vc_all = materialize(long_numeric(df, columns).groupBy("variable", "value")
                         .agg(F.count(F.lit(1)).alias("n")))
    vc = vc_all.filter(F.col("value").isNotNull())
    x, w = F.col("value"), F.col("n")
    first = vc_all.groupBy("variable").agg(
        F.sum(F.when(x.isNotNull(), w).otherwise(0)).alias("count"), F.sum(w).alias("_rows"),
        (F.sum(F.when(x.isNotNull(), w * x)) / F.sum(F.when(x.isNotNull(), w))).alias("mean"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("unique"))
    # central moments in a second pass over the distinct values (one row per variable joined)
    d = x - F.col("mean")
    cm = vc.join(first.select("variable", "mean"), "variable").groupBy("variable").agg(
        F.sum(w * d * d).alias("_s2"), F.sum(w * d * d * d).alias("_s3"), F.sum(w * d * d * d * d).alias("_s4"))
    mom = first.join(cm, "variable", "left")
    n = F.col("count").cast("double")
    m2, m3, m4 = F.col("_s2") / n, F.col("_s3") / n, F.col("_s4") / n
    var = F.col("_s2") / (n - 1)
    g1 = m3 / F.pow(m2, 1.5)
    g2 = m4 / (m2 * m2) - 3.0
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    mom = mom.select(
        "variable", "count", (F.col("_rows") - F.col("count")).alias("missing"),
        (F.try_divide((F.col("_rows") - F.col("count")) * 100.0, F.col("_rows"))).alias("missing_pct"),
        "unique", "mean", F.when(n > 1, F.sqrt(var)).alias("std"), F.when(n > 1, var).alias("variance"),
        "min", "max", (F.col("max") - F.col("min")).alias("range"),
        # a constant column has skew and kurtosis 0 (as pandas reports them)
        F.when(n > 2, F.when(m2 > 0, skew).otherwise(0.0)).alias("skewness"),
        F.when(n > 3, F.when(m2 > 0, kurt).otherwise(0.0)).alias("kurtosis"),
        F.when(F.col("mean") != 0, F.when(n > 1, F.sqrt(var)) / F.col("mean") * 100).alias("cv"))
    mode = _mode_from_counts(vc, ["variable"]).select("variable", "mode")
    q = quantiles_from_counts(vc, [0.25, 0.5, 0.75], ["variable"], names=["_q1", "median", "_q3"])
    out = mom.join(mode, "variable").join(q, "variable")
    return out.select("variable", "count", "missing", "missing_pct", "unique", "mean", "median", "mode",
                      "std", "variance", "min", "max", "range", (F.col("_q3") - F.col("_q1")).alias("iqr"),
                      "skewness", "kurtosis", "cv")


def percentile_table(df: DataFrame, columns: list[str], percentiles: list[float] | None = None) -> DataFrame:
    """Exact 1, 5, 25, 50, 75, 95, 99 % per variable (``approx=True`` path:
    ``percentile_approx`` when an approximation is acceptable)."""
    percentiles = percentiles or K.PERCENTILES
    names = [f"p{round(p * 100)}" for p in percentiles]
    return exact_quantiles(long_numeric(df, columns), percentiles, ["variable"], names=names)


def approx_percentile_table(df: DataFrame, columns: list[str], percentiles: list[float] | None = None,
                            accuracy: int = 10000) -> DataFrame:
    percentiles = percentiles or K.PERCENTILES
    names = [f"p{round(p * 100)}" for p in percentiles]
    g = long_numeric(df, columns).groupBy("variable").agg(
        F.percentile_approx("value", percentiles, accuracy).alias("_q"))
    return g.select("variable", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def outliers_iqr(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Per variable: q1, q3, bounds q1 - k*IQR and q3 + k*IQR, outlier count and %."""
    # one scan to (variable, value) counts; quantiles and outliers both read that table
    vc = materialize(long_numeric(df, columns).filter(F.col("value").isNotNull())
                     .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    q = quantiles_from_counts(vc, [0.25, 0.75], ["variable"], val="value", names=["q1", "q3"])
    b = q.select("variable", "q1", "q3", (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
                 (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_bound"))
    # one row per variable: a bounded broadcast
    j = vc.join(F.broadcast(b), "variable")
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    g = j.groupBy("variable", "q1", "q3", "lower_bound", "upper_bound").agg(
        F.sum(F.when(out, F.col("n")).otherwise(0)).cast("bigint").alias("outliers_count"),
        F.sum("n").alias("_n"))
    return g.select("variable", "q1", "q3", "lower_bound", "upper_bound", "outliers_count",
                    (F.col("outliers_count") * 100.0 / F.col("_n")).alias("outliers_pct"))


def flag_outliers(df: DataFrame, column: str, k: float = 1.5, name: str | None = None) -> DataFrame:
    """The rows themselves with an outlier flag (bounds broadcast: one row)."""
    b = outliers_iqr(df, [column], k).select("lower_bound", "upper_bound")
    name = name or f"{column}_outlier"
    x = F.col(column)
    return df.crossJoin(F.broadcast(b)).withColumn(
        name, (x < F.col("lower_bound")) | (x > F.col("upper_bound"))).drop("lower_bound", "upper_bound")


def shape_labels(profile: DataFrame) -> DataFrame:
    """Skew: |s| < 0.5 symmetric, else right / left; kurtosis > 1 heavy, < -1 light."""
    s, k = F.col("skewness"), F.col("kurtosis")
    return profile.select(
        "variable", "skewness", "kurtosis",
        F.when(F.abs(s) < 0.5, "approximately symmetric").when(s > 0, "right-skewed")
        .otherwise("left-skewed").alias("skew_label"),
        F.when(k > 1, "heavy tails / peaked").when(k < -1, "light tails / flat")
        .otherwise("approximately normal tails").alias("kurtosis_label"))


def profile_categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, missing, missing_pct, unique, mode (count, %), entropy (log2), Gini."""
    long = long_text(df, columns)
    vc_all = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    vc = vc_all.filter(F.col("value").isNotNull())
    tot = vc_all.groupBy("variable").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.sum("n").alias("_rows"))
    j = vc.join(tot, "variable")
    p = F.col("n") / F.col("count")
    g = j.groupBy("variable").agg(F.count(F.lit(1)).alias("unique"),
                                  (-F.sum(p * F.log2(p + F.lit(1e-15)))).alias("entropy"),
                                  (F.lit(1.0) - F.sum(p * p)).alias("gini_impurity"))
    mode = _mode_from_counts(vc, ["variable"])
    out = tot.join(g, "variable").join(mode, "variable")
    return out.select("variable", F.col("count").cast("bigint").alias("count"),
                      F.col("missing").cast("bigint").alias("missing"),
                      (F.col("missing") * 100.0 / F.col("_rows")).alias("missing_pct"), "unique", "mode",
                      "mode_count", (F.col("mode_count") * 100.0 / F.col("count")).alias("mode_pct"),
                      "entropy", "gini_impurity")


def value_counts_topk(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """Top k categories (count desc, value asc) with %, and how many more
    categories exist.  The limit is the feature (a top-k report)."""
    vc = materialize(df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
                     .agg(F.count(F.lit(1)).alias("n")))  # one scan; the top-k and the totals read it
    tot = vc.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_u"))
    top = vc.orderBy(F.desc("n"), "value").limit(k)
    return top.crossJoin(F.broadcast(tot)).select(
        F.lit(column).alias("variable"), "value", "n", (F.col("n") * 100.0 / F.col("_t")).alias("pct"),
        F.greatest(F.col("_u") - k, F.lit(0)).alias("n_more"))


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """count, mean, median, std, min, max of ``value`` per category."""
    sub = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("value")).dropna()
    g = sub.groupBy("_g").agg(F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
                              F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                              F.max("value").alias("max"))
    med = exact_quantiles(sub, [0.5], ["_g"], names=["median"])
    return g.join(med, "_g").select(F.col("_g").alias(group), "count", "mean", "median", "std", "min", "max")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table of observed cells: counts and % of all / row / column.
    Margins come from windows over the (levels x levels) counts table."""
    g = df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    all_ = F.sum("n").over(Window.partitionBy())
    return g.select(a, b, "n", (F.col("n") * 100.0 / all_).alias("pct_all"),
                    (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(a))).alias("pct_row"),
                    (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(b))).alias("pct_col"))


def crosstab_wide(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts with one column per level of ``b`` (zero where unobserved)."""
    return df.dropna(subset=[a, b]).groupBy(a).pivot(b).count().fillna(0)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; count and density."""
    x = F.col(column).cast("double")
    # two narrow scans with partial aggregates (the range, then at most ``bins``
    # rows a task): near-unique values are never shuffled
    vals = df.select(x.alias("x")).dropna()
    rng = vals.agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.count("x").alias("_n"))
    j = vals.crossJoin(F.broadcast(rng))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.least(F.floor((F.col("x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(idx).cast("int")
    g = j.groupBy(idx.alias("bin"), "_lo", "_hi", "_n").agg(F.count("x").alias("count"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return g.select("bin", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"), "count",
                    F.try_divide(F.col("count"), F.col("_n") * width).alias("density"))


def kde_curve(df: DataFrame, column: str, grid: int = 100, group: str | None = None, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid (Scott bandwidth n^(-1/5) * std).

    Rows are first reduced to distinct (group, value) counts; each distinct
    value then meets the fixed grid (``grid`` points, generated in the
    pipeline) and a partial aggregate folds the kernel sums per grid point."""
    gcols = [group] if group else []
    x = F.col(column).cast("double")
    base = df.select(*gcols, x.alias("x")).dropna()
    vc = base.groupBy(*gcols, "x").agg(F.count(F.lit(1)).alias("c"))
    st = base.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("x").alias("_sd"),
                                  F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    st = st.select(*gcols, "_n", "_lo", "_hi", (F.col("_sd") * F.pow(F.col("_n"), -0.2)).alias("_h"))
    j = vc.join(st, gcols) if gcols else vc.crossJoin(F.broadcast(st))  # per-group stats: AQE decides
    pts = F.sequence(F.lit(0), F.lit(grid - 1))
    e = j.select(*gcols, "x", "c", "_n", "_h", "_lo", "_hi", F.explode(pts).alias("i"))
    lo = F.col("_lo") - cut * F.col("_h")
    hi = F.col("_hi") + cut * F.col("_h")
    gx = lo + (hi - lo) * F.col("i") / F.lit(grid - 1)
    z = (gx - F.col("x")) / F.col("_h")
    k = F.col("c") * F.exp(-0.5 * z * z) / (F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
    g = e.groupBy(*gcols, "i", gx.alias("x"), "_n").agg(F.sum(k).alias("_s"))
    return g.select(*gcols, F.col("i").alias("grid_index"), "x", (F.col("_s") / F.col("_n")).alias("density"))


def box_stats(df: DataFrame, value: str, group: str | None = None, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count per group."""
    gcols = [group] if group else []
    sub = df.select(*gcols, F.col(value).cast("double").alias("value")).dropna()
    # one scan to (group, value) counts; everything below reads that table
    vc = materialize(sub.groupBy(*gcols, "value").agg(F.count(F.lit(1)).alias("n")))
    q = quantiles_from_counts(vc, [0.25, 0.5, 0.75], gcols, val="value", names=["q1", "median", "q3"])
    q = q.select("*", (F.col("q3") - F.col("q1")).alias("iqr"))
    # one row per group: AQE broadcasts it when small; without groups it is one row
    j = vc.join(q, gcols) if gcols else vc.crossJoin(F.broadcast(q))
    lo_f = F.col("q1") - k * F.col("iqr")
    hi_f = F.col("q3") + k * F.col("iqr")
    v = F.col("value")
    g = j.groupBy(*gcols, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo_f, v)).alias("whisker_low"), F.max(F.when(v <= hi_f, v)).alias("whisker_high"),
        F.sum(F.when((v < lo_f) | (v > hi_f), F.col("n")).otherwise(0)).cast("bigint").alias("n_outliers"),
        F.sum("n").alias("n"))
    return g


def density_2d(df: DataFrame, x: str, y: str, gridsize: int = 20) -> DataFrame:
    """Counts over an even gridsize x gridsize grid spanning both ranges."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    # two narrow scans: the ranges, then partial counts of at most gridsize² cells a task
    sub = df.select(xs.alias("x"), ys.alias("y")).dropna()
    rng = sub.agg(F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    j = sub.crossJoin(F.broadcast(rng))  # one row

    def cell(v, lo, hi):
        i = F.least(F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * gridsize), F.lit(gridsize - 1))
        return F.when(F.col(hi) == F.col(lo), F.lit(0)).otherwise(i).cast("int")

    return j.groupBy(cell("x", "_x0", "_x1").alias("x_bin"), cell("y", "_y0", "_y1").alias("y_bin")) \
        .agg(F.count(F.lit(1)).alias("count"))


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of y on x (complete pairs), with r²."""
    return df.agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
                  F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
                  F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
                  F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"))


def seed_summary(metrics: DataFrame, metric_cols: list[str], seed_col: str = "seed") -> DataFrame:
    """Mean, population std, min, max and range of each metric across seeds."""
    long = metrics.select(seed_col, *[F.col(c).cast("double").alias(c) for c in metric_cols]) \
        .unpivot([seed_col], metric_cols, "metric", "value")
    return long.groupBy("metric").agg(
        F.count("value").alias("n_seeds"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        (F.max("value") - F.min("value")).alias("range"))


def quick_profile(df: DataFrame, columns: list[str] | None = None, max_levels: int = 10,
                  approx: bool = False) -> DataFrame:
    """Profile every column by its detected kind, in one long result.

    The kinds are decided from the schema and one distinct-count pass (a
    bounded collect: one row per column), then each kind is profiled by the
    grouped operators above."""
    from credspark.operators.features import detect_column_kinds
    kinds = {r["column_name"]: r["kind"] for r in detect_column_kinds(df, columns, max_levels, approx).collect()}
    num = [c for c, k in kinds.items() if k == "numerical"]
    cat = [c for c, k in kinds.items() if k == "categorical"]
    parts = []
    if num:
        p = profile_numeric(df, num)
        parts.append(p.select("variable", F.lit("numerical").alias("kind"), "count", "missing", "unique",
                              F.col("mode").cast("string").alias("mode"), "mean", "std", "min", "max",
                              F.lit(None).cast("double").alias("entropy")))
    if cat:
        p = profile_categorical(df, cat)
        parts.append(p.select("variable", F.lit("categorical").alias("kind"), "count", "missing", "unique",
                              "mode", F.lit(None).cast("double").alias("mean"),
                              F.lit(None).cast("double").alias("std"), F.lit(None).cast("double").alias("min"),
                              F.lit(None).cast("double").alias("max"), "entropy"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def qq_points(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Normal probability plot data: ordered values against normal quantiles
    of Filliben's order-statistic medians, and the least-squares line.

    The order comes from distributed row numbers; quantiles are plain column
    arithmetic; the fit is three aggregates (slope, intercept, r)."""
    x = df.select(F.col(column).cast("double").alias("value")).dropna()
    n = x.count()
    rn = row_numbers(x, "value", name="i")
    i = F.col("i").cast("double")
    last = 0.5 ** (1.0 / n) if n else 0.0
    m = F.when(F.col("i") == n, F.lit(last)).when(F.col("i") == 1, F.lit(1.0 - last)) \
        .otherwise((i - 0.3175) / (n + 0.365))
    pts = with_normal_quantile(rn, m, "theoretical_quantile").select(
        "i", F.col("value").alias("ordered_value"), "theoretical_quantile")
    fit = pts.agg(F.regr_slope("ordered_value", "theoretical_quantile").alias("slope"),
                  F.regr_intercept("ordered_value", "theoretical_quantile").alias("intercept"),
                  F.corr("ordered_value", "theoretical_quantile").alias("r"), F.count(F.lit(1)).alias("n"))
    return pts, fit
