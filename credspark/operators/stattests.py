"""Hypothesis tests and association measures.

Every statistic is built from grouped aggregates (counts, sums, moments,
rank sums from the distributed ranks of ``ranks``); p-values are applied to
the final one-row-per-test results by ``functions.distributions``.  Group
order, where a test is asymmetric, is order of first appearance (smallest
row id), as the source's ``unique()`` order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.distributions import (p_chi2, p_f, p_norm_two_sided, p_norm_upper, p_t_two_sided,
                                               with_normal_quantile)
from credspark.operators.batch_fits import summed
from credspark.operators.profile import long_numeric, quantiles_from_counts
from credspark.operators.ranks import running_totals
from credspark.session import materialize

ALPHA = 0.05


def _strength(r: Column) -> Column:
    a = F.abs(r)
    out = None
    for edge, lab in K.CORR_STRENGTH_EDGES:
        out = F.when(a < edge, lab) if out is None else out.when(a < edge, lab)
    return out.otherwise(K.CORR_STRENGTH_TOP)


# ------------------------------------------------------------ correlation

def _corr_row(df: DataFrame, x: str, y: str, method: str) -> DataFrame:
    n = F.col("n_pairs").cast("double")
    r = F.col("correlation")
    t = r * F.sqrt((n - 2) / (F.lit(1.0) - r * r))
    return df.select(F.lit(x).alias("variable1"), F.lit(y).alias("variable2"), F.lit(method).alias("method"),
                     "n_pairs", "correlation", (r * r).alias("r_squared"), t.alias("t_stat"),
                     _strength(r).alias("strength"),
                     F.when(r > 0, "positive").otherwise("negative").alias("direction"))


def corr_pearson(df: DataFrame, x: str, y: str, with_p: bool = True) -> DataFrame:
    """Pearson r on complete pairs (needs 3), r², t, strength and direction labels."""
    sub = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    g = sub.agg(F.count(F.lit(1)).alias("n_pairs"), F.corr("x", "y").alias("correlation")) \
        .filter(F.col("n_pairs") >= 3)
    out = _corr_row(g, x, y, "pearson")
    return _with_t_p(out) if with_p else out


def _with_t_p(out: DataFrame) -> DataFrame:
    p = p_t_two_sided(F.col("t_stat"), F.col("n_pairs") - 2)
    return out.withColumn("p_value", p).withColumn("significant", F.col("p_value") < ALPHA)


def corr_spearman(df: DataFrame, x: str, y: str, id_col: str = K.ROW_ID, with_p: bool = True) -> DataFrame:
    """Spearman rho: Pearson r of average ranks on complete pairs, computed
    over distinct (x, y) pairs weighted by their counts."""
    # ONE pass over the rows to distinct (x, y) pairs with counts; ranks and the
    # correlation are then weighted sums over pairs (no join back to rows, so
    # a value shared by a third of the rows is one pair row, not a hot key)
    pairs = materialize(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
                        .dropna().groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")))

    def ranks(col: str, name: str) -> DataFrame:
        v = pairs.groupBy(col).agg(F.sum("c").alias("n"))
        cum = running_totals(v, col, ["n"])
        return cum.select(col, (F.col("n_cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias(name))

    j = pairs.join(ranks("x", "rx"), "x").join(ranks("y", "ry"), "y")
    c = F.col("c")
    m = j.agg(F.sum(c).alias("n_pairs"), (F.sum(c * F.col("rx")) / F.sum(c)).alias("_mx"),
              (F.sum(c * F.col("ry")) / F.sum(c)).alias("_my"))
    dx, dy = F.col("rx") - F.col("_mx"), F.col("ry") - F.col("_my")
    cm = j.crossJoin(F.broadcast(m)).groupBy("n_pairs").agg(  # m: one row
        F.sum(c * dx * dy).alias("_sxy"), F.sum(c * dx * dx).alias("_sxx"), F.sum(c * dy * dy).alias("_syy"))
    g = cm.select("n_pairs", (F.col("_sxy") / F.sqrt(F.col("_sxx") * F.col("_syy"))).alias("correlation")) \
        .filter(F.col("n_pairs") >= 3)
    out = _corr_row(g, x, y, "spearman")
    return _with_t_p(out) if with_p else out


def point_biserial(df: DataFrame, feature: str, target: str = K.TARGET, with_p: bool = True) -> DataFrame:
    """Pearson r between a numeric feature and the binary target."""
    return corr_pearson(df, target, feature, with_p).withColumn("variable1", F.lit(feature)) \
        .withColumn("variable2", F.lit(target)).withColumn("method", F.lit("point_biserial"))


# ---------------------------------------------------------- normality

def normality_dagostino(df: DataFrame, columns: list[str], with_p: bool = True) -> DataFrame:
    """D'Agostino-Pearson K² from the four moments (needs n >= 20):
    skewness z (D'Agostino 1970) and kurtosis z (Anscombe & Glynn 1983);
    p = exp(-K²/2), the chi-square(2) tail, is closed form."""
    long = long_numeric(df, columns).dropna()
    g = long.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.skewness("value").alias("g1"),
                                     F.kurtosis("value").alias("g2")).filter(F.col("n") >= 20)
    n = F.col("n").cast("double")
    # skew test
    y = F.col("g1") * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + F.sqrt(2.0 * (beta2 - 1))
    delta = F.lit(1.0) / F.sqrt(0.5 * F.ln(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    yy = F.when(y == 0, F.lit(1.0)).otherwise(y)
    zs = delta * F.ln(yy / alpha + F.sqrt((yy / alpha) * (yy / alpha) + 1))
    # kurtosis test (b2 is Pearson's, not excess)
    b2 = F.col("g2") + 3.0
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    term1 = F.lit(1.0) - 2.0 / (9.0 * a)
    den = F.lit(1.0) + x * F.sqrt(2.0 / (a - 4.0))
    term2 = F.signum(den) * F.cbrt((F.lit(1.0) - 2.0 / a) / F.abs(den))
    zk = (term1 - term2) / F.sqrt(2.0 / (9.0 * a))
    out = g.select("variable", "n", zs.alias("skew_z"), zk.alias("kurtosis_z"))
    out = out.withColumn("k2", F.col("skew_z") * F.col("skew_z") + F.col("kurtosis_z") * F.col("kurtosis_z"))
    if with_p:
        out = out.withColumn("p_value", F.exp(-F.col("k2") / 2.0)) \
            .withColumn("normal", F.col("p_value") > ALPHA)
    return out


# Royston (1995) polynomial coefficients for the Shapiro-Wilk W (fixed values)
_SW_C1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
_SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_SW_C3 = [0.544, -0.39978, 0.025054, -6.714e-4]
_SW_C4 = [1.3822, -0.77857, 0.062767, -0.0020322]
_SW_C5 = [-1.5861, -0.31082, -0.083751, 0.0038915]
_SW_C6 = [-0.4803, -0.082676, 0.0030302]
_SW_G = [-2.273, 0.459]


def _poly(c: list[float], x: Column) -> Column:
    out = F.lit(c[-1])
    for coef in reversed(c[:-1]):
        out = out * x + F.lit(coef)
    return out


#: Positions at either end whose scores are summed one by one; between them a formula holds to 1e-12.
END_POSITIONS = 64


def _density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def end_scores(groups: DataFrame, keys: list[str]) -> DataFrame:
    """``groups`` (one row each, with its n) with ``ends``, the expected normal scores m_i of its first END_POSITIONS
    (or half its) positions, and ``summ2``, the sum of m_i^2 over all positions.

    m_i = quantile((i - 0.375) / (n + 0.25)) and m_(n + 1 - i) = -m_i.  Between the ends the sum is the
    Euler-Maclaurin midpoint formula on the integral of z^2, which is P - z f(z) with f the density."""
    half = F.least(F.lit(END_POSITIONS).cast("long"), F.floor((F.col("n") + 1) / 2))
    n = F.col("n") + 0.25
    each = groups.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), half)))     # 64 rows each at most
    each = with_normal_quantile(each, (F.col("_i") - 0.375) / n, "_m")
    ends = each.groupBy(*keys, "n", "mean").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda v: v["_m"]).alias("ends"))
    k = F.size("ends")
    ends = ends.withColumn("_k", k)
    # the border between ends and middle, in the lower tail; the upper one is its mirror image
    ends = with_normal_quantile(ends, (F.col("_k") + 0.5 - 0.375) / (F.col("n") + 0.25), "_z")
    z, n = F.col("_z"), F.col("n") + 0.25
    f = _density(z)
    inside = n * ((F.lit(1.0) - 2 * (F.col("_k") + 0.5 - 0.375) / n) + 2 * z * f)
    slope = 2 * z / (n * f)
    third = 2 * z * (4 + 2 * z * z) / F.pow(n * f, 3)
    middle = inside + 2 * slope / 24 - 2 * 7 / 5760 * third
    squares = F.aggregate("ends", F.lit(0.0), lambda a, m: a + m * m)
    # of an odd number of positions that all lie in the ends, the middle one (score 0) is counted twice: no harm
    total = 2 * squares + F.when(F.col("n") > 2 * F.col("_k"), middle).otherwise(0.0)
    return ends.withColumn("summ2", total).drop("_k", "_z")


def score_sums(runs: DataFrame) -> DataFrame:
    """``runs`` (lo, hi, n, ends) with ``scores``: the sum of m_i for i = lo .. hi, 0 where hi < lo."""
    k, n = F.size("ends"), F.col("n")
    lo, hi = F.col("lo"), F.col("hi")
    head = F.aggregate(F.slice("ends", F.least(lo, k + 1).cast("int"),
                               F.greatest(F.least(hi, k) - F.least(lo, k + 1) + 1, F.lit(0)).cast("int")),
                       F.lit(0.0), lambda a, m: a + m)
    upper = F.greatest(n - k, k)      # positions beyond it mirror the first n - upper
    from_end, to_end = n + 1 - hi, F.least(n + 1 - lo, n - upper)
    tail = -F.aggregate(F.slice("ends", F.least(F.greatest(from_end, F.lit(1)), k + 1).cast("int"),
                                F.greatest(to_end - F.greatest(from_end, F.lit(1)) + 1, F.lit(0)).cast("int")),
                        F.lit(0.0), lambda a, m: a + m)
    a, b = F.greatest(lo, k + 1), F.least(hi, n - k)
    wide = n + 0.25
    runs = runs.withColumn("_head", head).withColumn("_tail", tail).withColumn("_a", a).withColumn("_b", b)
    some = F.col("_b") >= F.col("_a")
    runs = with_normal_quantile(runs, F.when(some, (F.col("_a") - 0.5 - 0.375) / wide), "_z1")
    runs = with_normal_quantile(runs, F.when(some, (F.col("_b") + 0.5 - 0.375) / wide), "_z2")
    f1, f2 = _density(F.col("_z1")), _density(F.col("_z2"))
    third = lambda z, f: (1 + 2 * z * z) / F.pow(wide * f, 3)
    middle = wide * (f1 - f2) - (1 / (wide * f2) - 1 / (wide * f1)) / 24 \
        + F.lit(7 / 5760) * (third(F.col("_z2"), f2) - third(F.col("_z1"), f1))
    total = F.col("_head") + F.col("_tail") + F.coalesce(middle, F.lit(0.0))
    return runs.withColumn("scores", F.when(hi >= lo, total).otherwise(0.0)).drop("_head", "_tail", "_a", "_b", "_z1",
                                                                                 "_z2")


def normality_shapiro(df: DataFrame, columns: list[str], min_n: int = 8, group: str | None = None,
                      with_p: bool = True) -> DataFrame:
    """Shapiro-Wilk W (Royston 1995 approximation of the coefficients and of
    the null distribution), one row per variable (and group) with min_n values.

    The approximation of p was fitted for n up to 5,000; larger samples have
    their row as any other, and ``p_extrapolated`` says so.  Order statistics come
    from distinct values: value counts are numbered by distributed running totals,
    and the expected scores of the positions that a value takes are summed in
    closed form (``score_sums``), so no count is expanded to rows and a value
    shared by a third of them is one row."""
    gcols = ["variable"] + (["grp"] if group else [])
    long = df.select(*([F.col(group).alias("grp")] if group else []), *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot(["grp"] if group else [], columns, "variable", "value").filter(F.col("value").isNotNull())
    vc = materialize(long.groupBy(*gcols, "value").agg(F.count(F.lit(1)).alias("c")))
    cnt = vc.groupBy(*gcols).agg(F.sum("c").alias("n"), (F.sum(F.col("value") * F.col("c")) / F.sum("c")).alias("mean"))
    # one row for each variable and group, with the scores of its outermost positions
    ends = materialize(end_scores(cnt.filter(F.col("n") >= min_n), gcols))
    cum = running_totals(vc, "value", ["c"], gcols).join(ends, gcols)
    first, last, nn = F.col("c_cum") - F.col("c") + 1, F.col("c_cum"), F.col("n")
    inner = cum.withColumn("lo", F.greatest(first, F.lit(3))).withColumn("hi", F.least(last, nn - 2))
    scored = score_sums(inner.withColumn("first", first))
    at = lambda place: F.max(F.when((F.col("first") <= place) & (F.col("c_cum") >= place), F.col("value")))
    away = F.col("value") - F.col("mean")
    g = scored.groupBy(*gcols, "n").agg(
        F.sum(F.col("value") * F.col("scores")).alias("s_int"), F.sum(F.col("c") * away * away).alias("ssq"),
        at(F.lit(1)).alias("x1"), at(F.lit(2)).alias("x2"), at(nn - 1).alias("xn1"), at(nn).alias("xn"),
        F.first("summ2").alias("summ2"), F.first(-F.col("ends")[0]).alias("mn"), F.first(-F.col("ends")[1]).alias("mn1"))
    n = F.col("n").cast("double")
    rsn = F.lit(1.0) / F.sqrt(n)
    ss = F.sqrt(F.col("summ2"))
    a1 = _poly(_SW_C1, rsn) + F.col("mn") / ss
    a2 = _poly(_SW_C2, rsn) + F.col("mn1") / ss
    fac = F.sqrt((F.col("summ2") - 2 * F.col("mn") ** 2 - 2 * F.col("mn1") ** 2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
    # n > 5 always here (min_n >= 8): two corrected coefficients per tail
    num = F.col("s_int") / fac + a1 * (F.col("xn") - F.col("x1")) + a2 * (F.col("xn1") - F.col("x2"))
    w = F.least(num * num / F.col("ssq"), F.lit(1.0))
    out = g.select(*gcols, "n", w.alias("w"), (F.col("n") > 5000).alias("p_extrapolated"))
    if not with_p:
        return out
    ln_n = F.ln(n)
    # 4 <= n <= 11 (only n = 8..11 reach here) and n >= 12 branches
    gamma = _poly(_SW_G, n)
    small_z = (-F.ln(gamma - F.log1p(-F.col("w"))) - _poly(_SW_C3, n)) / F.exp(_poly(_SW_C4, n))
    big_z = (F.ln(F.lit(1.0) - F.col("w")) - _poly(_SW_C5, ln_n)) / F.exp(_poly(_SW_C6, ln_n))
    z = F.when(F.col("n") <= 11, small_z).otherwise(big_z)
    return out.withColumn("p_value", p_norm_upper(z)).withColumn("normal", F.col("p_value") > ALPHA)


# ------------------------------------------------------- group comparison

def _groups(df: DataFrame, group: str, value: str, id_col: str | None) -> DataFrame:
    cols = [F.col(group).alias("g"), F.col(value).cast("double").alias("x")]
    if id_col:
        cols.append(F.col(id_col).alias("_id"))
    return df.select(*cols).dropna(subset=["g", "x"])


def _two_groups(groups: DataFrame) -> DataFrame:
    """``groups`` (one row per group); raises where there are not exactly two."""
    found = groups.limit(3).count()
    if found != 2:
        raise ValueError(f"exactly 2 groups are compared; there are {'more' if found > 2 else found}")
    return groups


def group_moments(sub: DataFrame) -> DataFrame:
    return sub.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
                                F.var_samp("x").alias("var"))


def ttest_ind(df: DataFrame, group: str, value: str, id_col: str | None = K.ROW_ID,
              with_p: bool = True) -> DataFrame:
    """Pooled-variance two-sample t of the two groups; Cohen's d with the
    pooled std (0 when it is 0).  Any other number of groups is an error."""
    sub = _groups(df, group, value, id_col)
    first = F.min("_id") if "_id" in sub.columns else F.min("g")
    mo = sub.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
                              F.var_samp("x").alias("var"), first.alias("_first"))  # one pass
    mo = _two_groups(materialize(mo))
    mo = mo.select("*", (F.row_number().over(Window.orderBy("_first")) - 1).alias("gi"))  # one row per group
    a = mo.filter("gi = 0").select(F.col("g").alias("group1"), F.col("n").alias("n1"), F.col("mean").alias("m1"),
                                   F.col("var").alias("v1"))
    b = mo.filter("gi = 1").select(F.col("g").alias("group2"), F.col("n").alias("n2"), F.col("mean").alias("m2"),
                                   F.col("var").alias("v2"))
    j = a.crossJoin(b)  # one row each
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    sp2 = ((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2")) / (n1 + n2 - 2)
    t = (F.col("m1") - F.col("m2")) / F.sqrt(sp2 * (1 / n1 + 1 / n2))
    d = F.when(F.sqrt(sp2) > 0, (F.col("m1") - F.col("m2")) / F.sqrt(sp2)).otherwise(0.0)
    out = j.select("group1", "group2", "n1", "n2", t.alias("t_stat"), (F.col("n1") + F.col("n2") - 2).alias("dof"),
                   d.alias("cohens_d"),
                   F.when(F.abs(d) < 0.2, "small").when(F.abs(d) < 0.8, "medium").otherwise("large")
                   .alias("effect_label"))
    if with_p:
        out = out.withColumn("p_value", p_t_two_sided(F.col("t_stat"), F.col("dof")))
    return out


def _group_value_counts(sub: DataFrame) -> DataFrame:
    """(g, x, c[, first id]) in ONE pass over the rows, materialized: every
    later branch (group order, ranks, rank sums, ties) reads this table."""
    aggs = [F.count(F.lit(1)).alias("c")] + ([F.min("_id").alias("_first")] if "_id" in sub.columns else [])
    return materialize(sub.groupBy("g", "x").agg(*aggs))


def _rank_sums(per: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (g, x, c): per group n and rank sum, and the tie term
    sum(t^3 - t) with N, over the pooled values (average ranks)."""
    v = per.groupBy("x").agg(F.sum("c").alias("t"))
    cum = running_totals(v, "x", ["t"])
    ranks = cum.select("x", "t", (F.col("t_cum") - F.col("t") + (F.col("t") + 1) / 2.0).alias("rank"))
    rs = per.join(ranks, "x").groupBy("g").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("rank")).alias("r"))
    ties = ranks.agg((F.sum(F.col("t") ** 3 - F.col("t"))).alias("tie"), F.sum("t").alias("N"))
    return rs, ties


def mann_whitney_u(df: DataFrame, group: str, value: str, id_col: str | None = K.ROW_ID,
                   with_p: bool = True) -> DataFrame:
    """Two-sided U of the two groups: U1 = R1 - n1(n1+1)/2; normal
    approximation with tie correction and continuity (asymptotic only).
    Any other number of groups is an error; without an id column the smaller
    group value comes first."""
    per = _group_value_counts(_groups(df, group, value, id_col))
    first = per.groupBy("g").agg((F.min("_first") if "_first" in per.columns else F.min("g")).alias("_first"))
    order = _two_groups(first).select("g", (F.row_number().over(Window.orderBy("_first")) - 1).alias("gi"))  # two rows
    rs, ties = _rank_sums(per)
    rs = rs.join(order, "g")
    a = rs.filter("gi = 0").select(F.col("g").alias("group1"), F.col("n").alias("n1"), F.col("r").alias("r1"))
    b = rs.filter("gi = 1").select(F.col("g").alias("group2"), F.col("n").alias("n2"))
    j = a.crossJoin(b).crossJoin(ties)  # one row each
    n1, n2, nn = F.col("n1").cast("double"), F.col("n2").cast("double"), F.col("N").cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    u = F.greatest(u1, n1 * n2 - u1)
    s = F.sqrt(n1 * n2 / 12.0 * ((nn + 1) - F.col("tie") / (nn * (nn - 1))))
    z = (u - n1 * n2 / 2.0 - 0.5) / s
    out = j.select("group1", "group2", "n1", "n2", u1.alias("u_stat"), z.alias("z"))
    if with_p:
        out = out.withColumn("p_value", p_norm_two_sided(F.col("z")))
    return out


def anova_oneway(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """One-way ANOVA F and eta² = SS_between / SS_total."""
    sub = _groups(df, group, value, None)
    mo = group_moments(sub)
    return _anova_from_moments(mo, with_p)


def _anova_from_moments(mo: DataFrame, with_p: bool) -> DataFrame:
    tot = mo.agg(F.sum("n").alias("_nt"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("gm"),
                 F.count(F.lit(1)).alias("k"))
    j = mo.crossJoin(tot)  # one row
    g = j.groupBy("_nt", "k").agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("gm")) ** 2).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0))).alias("ssw"))
    dfb, dfw = F.col("k") - 1, F.col("_nt") - F.col("k")
    f = (F.col("ssb") / dfb) / (F.col("ssw") / dfw)
    eta = F.when(F.col("ssb") + F.col("ssw") > 0, F.col("ssb") / (F.col("ssb") + F.col("ssw"))).otherwise(0.0)
    out = g.select(F.col("k").alias("n_groups"), F.col("_nt").alias("total_n"), f.alias("f_stat"),
                   dfb.alias("df_between"), dfw.alias("df_within"), eta.alias("eta_squared"),
                   F.when(eta < 0.01, "small").when(eta < 0.06, "medium").otherwise("large").alias("effect_label"))
    if with_p:
        out = out.withColumn("p_value", p_f(F.col("f_stat"), F.col("df_between"), F.col("df_within")))
    return out


def kruskal_wallis(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """Kruskal-Wallis H with tie correction."""
    rs, ties = _rank_sums(_group_value_counts(_groups(df, group, value, None)))
    g = rs.agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), F.count(F.lit(1)).alias("k")).crossJoin(ties)
    nn = F.col("N").cast("double")
    h = 12.0 / (nn * (nn + 1)) * F.col("s") - 3 * (nn + 1)
    c = F.lit(1.0) - F.col("tie") / (nn * nn * nn - nn)
    out = g.select(F.col("k").alias("n_groups"), F.col("N").alias("total_n"), (h / c).alias("h_stat"),
                   (F.col("k") - 1).alias("dof"))
    if with_p:
        out = out.withColumn("p_value", p_chi2(F.col("h_stat"), F.col("dof")))
    return out


def levene(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """Levene's test centred on group medians (Brown-Forsythe): one-way ANOVA
    of |x - median_g|.  Defined only when every group has 2 or more values."""
    per = _group_value_counts(_groups(df, group, value, None))  # one pass, materialized
    med = quantiles_from_counts(per.withColumnRenamed("c", "n"), [0.5], ["g"], val="x", names=["med"])
    z = per.join(med, "g").select("g", "c", F.abs(F.col("x") - F.col("med")).alias("z"))
    # weighted moments of |x - median| per group (c rows share each distinct value)
    m1 = z.groupBy("g").agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("z")) / F.sum("c")).alias("mean"))
    mo = z.join(m1, "g").groupBy("g", "n", "mean").agg(
        (F.sum(F.col("c") * (F.col("z") - F.col("mean")) ** 2) / (F.col("n") - 1)).alias("var"))
    ok = mo.agg(F.min("n").alias("_minn"))
    out = _anova_from_moments(mo, with_p).crossJoin(ok).filter(F.col("_minn") >= 2).drop("_minn")
    return out.withColumnRenamed("f_stat", "levene_stat").drop("eta_squared", "effect_label")


def compare_groups(df: DataFrame, group: str, value: str, parametric: bool = True,
                   id_col: str | None = K.ROW_ID, with_p: bool = True) -> DataFrame:
    """Choose the test by the number of groups (a bounded scalar, read once):
    2 groups -> t (parametric) or U; more -> ANOVA or Kruskal-Wallis; plus the
    effect size and Levene's test.  One row."""
    sub = _groups(df, group, value, id_col)
    k = sub.select("g").distinct().count()
    if k < 2:
        raise ValueError("need at least 2 groups")
    if k == 2:
        if parametric:
            t = ttest_ind(df, group, value, id_col, with_p)
            out = t.select(F.lit("Independent t-test").alias("test_name"), F.col("t_stat").alias("statistic"),
                           *(["p_value"] if with_p else []), F.col("cohens_d").alias("effect_size"),
                           F.lit("Cohen's d").alias("effect_size_name"), "effect_label")
        else:
            u = mann_whitney_u(df, group, value, id_col, with_p)
            d = ttest_ind(df, group, value, id_col, False).select("cohens_d", "effect_label")
            out = u.select(F.lit("Mann-Whitney U").alias("test_name"), F.col("u_stat").alias("statistic"),
                           *(["p_value"] if with_p else [])).crossJoin(d) \
                .withColumnRenamed("cohens_d", "effect_size").withColumn("effect_size_name", F.lit("Cohen's d"))
    else:
        a = anova_oneway(df, group, value, with_p)
        eff = a.select(F.col("eta_squared").alias("effect_size"), F.lit("Eta-squared").alias("effect_size_name"),
                       "effect_label")
        if parametric:
            out = a.select(F.lit("One-way ANOVA").alias("test_name"), F.col("f_stat").alias("statistic"),
                           *(["p_value"] if with_p else [])).crossJoin(eff)
        else:
            kw = kruskal_wallis(df, group, value, with_p)
            out = kw.select(F.lit("Kruskal-Wallis H").alias("test_name"), F.col("h_stat").alias("statistic"),
                            *(["p_value"] if with_p else [])).crossJoin(eff)
    lev = levene(df, group, value, with_p).select(
        "levene_stat", *([F.col("p_value").alias("levene_p")] if with_p else []))
    out = out.select(F.lit(int(k)).cast("bigint").alias("n_groups"), "*").join(lev, how="left")
    if with_p:
        out = out.withColumn("significant", F.col("p_value") < ALPHA) \
            .withColumn("equal_variances", F.col("levene_p") > ALPHA)
    return out


# ----------------------------------------------------------- chi-square

def chi2_long(long: DataFrame, yates: bool = True, with_p: bool = True) -> DataFrame:
    """Chi-square test of independence for every key of a long (key, a, b)
    table at once.  Uses chi² = sum over *observed* cells of O²/E - N, so no
    zero cells need to exist; the Yates 2x2 case enumerates its 4 cells;
    the share of cells with E < 5 counts, per row level, the column totals
    below 5N/R_i (an array of the column totals, one per level)."""
    # ONE pass over the rows; every table below (margins, cells, Yates) reads these cells
    obs = materialize(long.dropna(subset=["a", "b"]).groupBy("key", "a", "b").agg(F.count(F.lit(1)).alias("o")))
    rt = obs.groupBy("key", "a").agg(F.sum("o").alias("R"))
    ct = obs.groupBy("key", "b").agg(F.sum("o").alias("C"))
    nt = obs.groupBy("key").agg(F.sum("o").alias("N"))
    dims = rt.groupBy("key").agg(F.count(F.lit(1)).alias("r"), F.min("R").alias("minR")) \
        .join(ct.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("C").alias("minC"),
                                    F.collect_list(F.struct(F.col("b"), F.col("C"))).alias("cols")), "key") \
        .join(nt, "key").withColumn("dof", (F.col("r") - 1) * (F.col("c") - 1))
    e = obs.join(rt, ["key", "a"]).join(ct, ["key", "b"]).join(nt, "key") \
        .withColumn("E", F.col("R") * F.col("C") / F.col("N"))
    plain = e.groupBy("key").agg((F.sum(F.col("o") * F.col("o") / F.col("E"))).alias("_s"))
    low = rt.join(dims.select("key", "cols", "N"), "key").select(
        "key", F.size(F.filter("cols", lambda s: F.col("R") * s["C"] < 5 * F.col("N"))).alias("_low"))
    low = low.groupBy("key").agg(F.sum("_low").alias("n_low"))
    out = dims.join(plain, "key").join(low, "key").withColumn("chi2", F.col("_s") - F.col("N"))
    if yates:
        two = rt.join(dims.filter("dof = 1").select("key", "cols", "N"), "key") \
            .select("key", "a", "R", "N", F.explode("cols").alias("cc"))
        two = two.select("key", "a", F.col("cc.b").alias("b"), (F.col("R") * F.col("cc.C") / F.col("N")).alias("E"))
        two = two.join(obs, ["key", "a", "b"], "left").withColumn("o", F.coalesce("o", F.lit(0)))
        adj = F.greatest(F.abs(F.col("o") - F.col("E")) - 0.5, F.lit(0.0))
        yc = two.groupBy("key").agg(F.sum(adj * adj / F.col("E")).alias("_y"))
        out = out.join(yc, "key", "left").withColumn(
            "chi2", F.when(F.col("dof") == 1, F.col("_y")).otherwise(F.col("chi2")))
    md = F.least(F.col("r"), F.col("c")) - 1
    v = F.when((md > 0) & (F.col("N") > 0), F.sqrt(F.col("chi2") / (F.col("N") * md))).otherwise(0.0)
    min_e = F.col("minR") * F.col("minC") / F.col("N")
    res = out.select("key", F.col("N").alias("n_obs"), F.col("chi2").alias("chi2_stat"), "dof",
                     min_e.alias("min_expected"),
                     (F.col("n_low") * 100.0 / (F.col("r") * F.col("c"))).alias("pct_cells_low_expected"),
                     (min_e >= 5).alias("assumption_met"), v.alias("cramers_v"),
                     F.when(v < 0.1, "negligible").when(v < 0.3, "small").when(v < 0.5, "medium")
                     .otherwise("large").alias("effect_label"))
    if with_p:
        res = res.withColumn("p_value", F.when(F.col("dof") > 0, p_chi2(F.col("chi2_stat"), F.col("dof")))
                             .otherwise(1.0)).withColumn("significant", F.col("p_value") < ALPHA)
    return res


def chi2_independence(df: DataFrame, a: str, b: str, yates: bool = True, with_p: bool = True) -> DataFrame:
    long = df.select(F.lit(f"{a}|{b}").alias("key"), F.col(a).cast("string").alias("a"),
                     F.col(b).cast("string").alias("b"))
    return chi2_long(long, yates, with_p).drop("key").select(F.lit(a).alias("variable1"),
                                                             F.lit(b).alias("variable2"), "*")


def chi2_expected(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, observed, expected) for every cell, also those never observed:
    row total x column total / N, from one pass over the rows."""
    obs = materialize(df.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).dropna()
                      .groupBy("a", "b").agg(F.count(F.lit(1)).alias("observed")))
    rt = obs.groupBy("a").agg(F.sum("observed").alias("_r"))
    ct = obs.groupBy("b").agg(F.sum("observed").alias("_c"))
    n = obs.agg(F.sum("observed").alias("_n"))
    cells = rt.crossJoin(ct).crossJoin(F.broadcast(n))  # the result itself: one row per cell
    return cells.join(obs, ["a", "b"], "left").select(
        F.col("a").alias(a), F.col("b").alias(b), F.coalesce("observed", F.lit(0)).alias("observed"),
        (F.col("_r") * F.col("_c") / F.col("_n")).alias("expected"))


def cramers_v(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    return chi2_independence(df, a, b, yates, with_p=False).select("variable1", "variable2", "n_obs", "cramers_v",
                                                                   "effect_label")


def feature_target_association(df: DataFrame, numeric: list[str], categorical: list[str],
                               target: str = K.TARGET, with_p: bool = True) -> DataFrame:
    """Every feature against the binary target: point-biserial r (numeric) or
    Cramér's V (categorical), sorted by absolute value; strong >= 0.3,
    moderate >= 0.1, weak below.  All features of a kind in one grouped pass."""
    parts = []
    if numeric:
        ln = df.select(F.col(target).cast("double").alias("y"), *[F.col(c).cast("double") for c in numeric]) \
            .unpivot(["y"], numeric, "feature", "x").dropna()
        g = ln.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.corr("y", "x").alias("correlation"))
        t = F.col("correlation") * F.sqrt((F.col("n") - 2) / (1 - F.col("correlation") ** 2))
        pn = g.select("feature", "correlation", F.lit("point_biserial").alias("method"), t.alias("_t"), "n")
        if with_p:
            pn = pn.withColumn("p_value", p_t_two_sided(F.col("_t"), F.col("n") - 2))
        parts.append(pn.drop("_t", "n"))
    if categorical:
        lc = df.select(F.col(target).cast("string").alias("b"), *[F.col(c).cast("string") for c in categorical]) \
            .unpivot(["b"], categorical, "key", "a")
        ch = chi2_long(lc, True, with_p)
        pc = ch.select(F.col("key").alias("feature"), F.col("cramers_v").alias("correlation"),
                       F.lit("cramers_v").alias("method"), *(["p_value"] if with_p else []))
        parts.append(pc)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    a = F.abs(F.col("correlation"))
    out = out.select("feature", "correlation", a.alias("abs_correlation"), "method",
                     *(["p_value", (F.col("p_value") < ALPHA).alias("significant")] if with_p else []),
                     F.when(a >= 0.3, "strong").when(a >= 0.1, "moderate").otherwise("weak").alias("strength"))
    return out.orderBy(F.desc("abs_correlation"), "feature")


#: Columns whose products with all others one pass adds up; wider tables take several passes.
PRODUCT_ROWS = 512


def _products(df: DataFrame, columns: list[str], shift: list[float], left: list[str], right: list[str],
              complete: bool = False) -> dict[str, np.ndarray]:
    """Sums over rows of products of column pairs, as d x d arrays: ``left`` and ``right`` name what each side of a
    product is, of v (the value less ``shift``), s (its square) and m (1 where it is there, v and s being 0 where not).
    Each task multiplies its rows as matrices and sends one partial sum; the plan does not grow with the pairs."""
    d, kinds = len(columns), sorted({*left, *right})
    base = np.array(shift)
    x = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))

    def over(first: int, last: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(left), last - first, d))
            for b in batches:
                v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - base
                there = ~np.isnan(v)
                if complete:
                    v, there = v[there.all(axis=1)], there[there.all(axis=1)]
                v = np.where(there, v, 0.0)
                of = {"v": v, "m": there.astype(float)}
                if "s" in kinds:
                    of["s"] = v * v
                for k, (p, q) in enumerate(zip(left, right)):
                    total[k] += of[p][:, first:last].T @ of[q]
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        return summed(x.mapInArrow(run, "sums binary"), len(left) * (last - first) * d).reshape(len(left), -1, d)

    blocks = [over(k, min(k + PRODUCT_ROWS, d)) for k in range(0, d, PRODUCT_ROWS)]
    return dict(zip(map("".join, zip(left, right)), np.concatenate(blocks, axis=1)))


def _column_moments(df: DataFrame, columns: list[str]) -> tuple[list[float], list[float]]:
    """Mean and sample deviation of every column (0 where undefined): one row."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return ([row[f"m{i}"] or 0.0 for i in range(len(columns))], [row[f"s{i}"] or 0.0 for i in range(len(columns))])


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """Pearson r of all pairs over their complete rows, from one pass of matrix
    products (after the means); pairs with |r| >= threshold, strongest first."""
    mean, _ = _column_moments(df, columns)
    g = _products(df, columns, mean, ["m", "v", "s", "v"], ["m", "m", "m", "v"])
    n, sx, sxx, sxy = g["mm"], g["vm"], g["sm"], g["vv"]     # of the pair's complete rows
    with np.errstate(invalid="ignore", divide="ignore"):
        var = sxx - sx * sx / n
        r = (sxy - sx * sx.T / n) / np.sqrt(var * var.T)
    flat = (var <= 1e-12 * sxx) | (var <= 1e-12 * sxx).T     # constant in those rows but for rounding
    hit = np.argwhere(np.triu((np.abs(r) >= threshold) & ~flat, 1))
    rows = [(columns[i], columns[j], float(np.clip(r[i, j], -1, 1))) for i, j in hit]
    out = df.sparkSession.createDataFrame(rows, "feature_1 string, feature_2 string, correlation double")
    return out.orderBy(F.desc(F.abs("correlation")), "feature_1", "feature_2")


def gram(df: DataFrame, columns: list[str]) -> tuple[np.ndarray, list[str]]:
    """Uncentred Gramian X'X of the complete rows, in one pass; columns with
    zero variance dropped.  Returns a d x d array (bounded by the schema)."""
    x = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    _, sd = _column_moments(x, columns)
    g = _products(x, columns, [0.0] * len(columns), ["v"], ["v"], complete=True)["vv"]
    keep = [i for i, s in enumerate(sd) if s > 0]
    return g[np.ix_(keep, keep)], [columns[i] for i in keep]


def vif(df: DataFrame, columns: list[str], threshold: float = 5.0) -> DataFrame:
    """Variance inflation factors without an added constant (uncentred):
    VIF_i = G_ii * (G^-1)_ii of the Gramian G computed by one Spark pass;
    only the d x d inverse is local.  Labels: >= 10 High, >= threshold
    Moderate, else OK."""
    spark = df.sparkSession
    g, names = gram(df, columns)
    if len(names) < 2:
        return spark.createDataFrame([], "feature string, vif double, status string")
    inv = np.linalg.pinv(g)
    rows = [(n, float(g[i, i] * inv[i, i])) for i, n in enumerate(names)]
    out = spark.createDataFrame(rows, "feature string, vif double")
    return out.withColumn("status", F.when(F.col("vif") >= 10, "High").when(F.col("vif") >= threshold, "Moderate")
                          .otherwise("OK")).orderBy(F.desc("vif"))


def suggest_drops(df: DataFrame, columns: list[str], corr_threshold: float = 0.7,
                  vif_threshold: float = 5.0) -> DataFrame:
    """Features to drop: of each highly correlated pair the one with the lower
    std (the second on ties), plus every feature with VIF >= threshold."""
    pairs = correlated_pairs(df, columns, corr_threshold)
    sd_row = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns])
    sd = sd_row.selectExpr(f"stack({len(columns)}, " + ", ".join(f"'{c}', `{c}`" for c in columns)
                           + ") as (feature, std)")
    j = pairs.join(F.broadcast(sd.withColumnRenamed("feature", "feature_1").withColumnRenamed("std", "s1")),
                   "feature_1").join(F.broadcast(sd.withColumnRenamed("feature", "feature_2")
                                                 .withColumnRenamed("std", "s2")), "feature_2")
    by_corr = j.select(F.when(F.col("s1") < F.col("s2"), F.col("feature_1")).otherwise(F.col("feature_2"))
                       .alias("feature"), F.lit("correlation").alias("reason"))
    by_vif = vif(df, columns, vif_threshold).filter(F.col("vif") >= vif_threshold) \
        .select("feature", F.lit("vif").alias("reason"))
    both = by_corr.unionByName(by_vif)
    return both.groupBy("feature").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
