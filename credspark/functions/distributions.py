"""Tail probabilities and normal quantiles (numpy), plus pandas-UDF wrappers.

Spark has no t, F, chi-square or normal tail functions, and scipy is not
available.  These helpers are applied to the *final* statistics rows (one
per variable or test), through Arrow-batched pandas UDFs; never to raw rows.

Methods: the published continued fractions and series (DLMF 8.7, 8.9, 8.17)
for the regularized incomplete beta and gamma, evaluated from the inside out,
``math.erfc`` for the normal tail, and Wichura's AS 241 for normal quantiles.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

def _depth(size: float) -> int:
    """Levels of a continued fraction, which converges in about the root of its parameters."""
    return 100 + int(8 * math.sqrt(max(size, 1.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """1 / (1 + d1 / (1 + d2 / (1 + ...))) of DLMF 8.17.22, from its deepest level upward."""
    value = 1.0
    for level in range(_depth(max(a, b)), 0, -1):
        m = level // 2
        if level % 2:
            d = -(a + m) * (a + b + m) / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + d * x / value
    return 1.0 / value


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if not (a > 0 and b > 0) or x is None or math.isnan(x):
        return float("nan")
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):       # the fraction converges fast on the other side
        return 1.0 - betainc(b, a, 1.0 - x)
    front = math.lgamma(a + b) - math.lgamma(a + 1.0) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(front) * _beta_fraction(a, b, x)


def gammaincc(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x): the power series of 1 - Q
    (DLMF 8.7.1) left of a + 1, the continued fraction 8.9.2 right of it."""
    if a <= 0 or x is None or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = 1
        while term > total * 1e-17:
            term *= x / (a + n)
            total += term
            n += 1
        return 1.0 - scale * total
    value = x
    for level in range(_depth(a), 0, -1):
        value = x + (level - a) / (1.0 + level / value)
    return scale / value


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0)) if z is not None and not math.isnan(z) else float("nan")


def t_sf(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    tail = 0.5 * betainc(df / 2.0, 0.5, df / (df + t * t))
    return tail if t > 0 else 1.0 - tail


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    if x is None or math.isnan(x) or k is None or k <= 0:
        return float("nan")
    return gammaincc(k / 2.0, x / 2.0)


def two_sided_t(t: float, df: float) -> float:
    if t is None or math.isnan(t):
        return float("nan")
    return min(1.0, 2.0 * t_sf(abs(t), df))


# Wichura (1988) AS 241, PPND16 coefficients (fixed values of the algorithm)
_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
      4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3]
_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
      2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3]
_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
      1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2,
      7.74545014278341407640e-4]
_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
      1.05075007164441684324e-9]
_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
      2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5,
      2.01033439929228813265e-7]
_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
      2.04426310338993978564e-15]


def _poly(c, x):
    out = np.zeros_like(x)
    for coef in reversed(c):
        out = out * x + coef
    return out


def norm_ppf(p) -> np.ndarray:
    """Standard normal quantile, vectorized (AS 241, about 1e-16 relative)."""
    p = np.asarray(p, dtype=float)
    q = p - 0.5
    out = np.full_like(p, np.nan)
    central = np.abs(q) <= 0.425
    if central.any():
        r = 0.180625 - q[central] ** 2
        out[central] = q[central] * _poly(_A, r) / _poly(_B, r)
    tail = ~central & (p > 0) & (p < 1)
    if tail.any():
        r = np.where(q[tail] < 0, p[tail], 1.0 - p[tail])
        r = np.sqrt(-np.log(r))
        near = r <= 5.0
        val = np.where(near, _poly(_C, r - 1.6) / _poly(_D, r - 1.6), _poly(_E, r - 5.0) / _poly(_F, r - 5.0))
        out[tail] = np.where(q[tail] < 0, -val, val)
    out[p == 0] = -np.inf
    out[p == 1] = np.inf
    return out


# ------------------------------------------------------------ Spark wrappers

def _vec(fn, *series):
    return pd.Series([fn(*[None if pd.isna(v) else float(v) for v in vals]) for vals in zip(*series)],
                     dtype="float64")


@F.pandas_udf(DoubleType())
def _t2_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(two_sided_t, t, df)


@F.pandas_udf(DoubleType())
def _f_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(DoubleType())
def _chi2_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, k)


@F.pandas_udf(DoubleType())
def _norm2_udf(z: pd.Series) -> pd.Series:
    return _vec(lambda v: float("nan") if v is None else min(1.0, 2.0 * norm_sf(abs(v))), z)


@F.pandas_udf(DoubleType())
def _normsf_udf(z: pd.Series) -> pd.Series:
    return _vec(norm_sf, z)


def _poly_of(c: list[float], x, lit):
    out = lit(c[-1])
    for coef in reversed(c[:-1]):
        out = out * x + lit(coef)
    return out


def with_normal_quantile(df: DataFrame, p: Column, name: str) -> DataFrame:
    """``df`` with the standard normal quantile of ``p`` (null outside (0, 1)) as column ``name``: AS 241 in plain
    arithmetic, in two projections so that the polynomials' argument is computed once."""
    step = df.withColumn("_np", p.cast("double"))
    step = step.withColumn("_nq", F.col("_np") - 0.5).withColumn(
        "_nr", F.when(F.abs("_nq") <= 0.425, F.lit(0.180625) - F.col("_nq") * F.col("_nq"))
        .otherwise(F.sqrt(-F.ln(F.least("_np", F.lit(1.0) - F.col("_np"))))))
    r, q = F.col("_nr"), F.col("_nq")
    ratio = lambda top, low, x: _poly_of(top, x, F.lit) / _poly_of(low, x, F.lit)
    tail = F.when(r <= 5, ratio(_C, _D, r - 1.6)).otherwise(ratio(_E, _F, r - 5.0))
    value = F.when(F.abs(q) <= 0.425, q * ratio(_A, _B, r)).otherwise(F.when(q < 0, -tail).otherwise(tail))
    inside = (F.col("_np") > 0) & (F.col("_np") < 1)
    return step.withColumn(name, F.when(inside, value)).drop("_np", "_nq", "_nr")


def normal_quantile_sql(p: str) -> str:
    """The same quantile as SQL text; ``p`` is a column name."""
    def poly(c, x):
        out = f"CAST({c[-1]!r} AS DOUBLE)"
        for coef in reversed(c[:-1]):
            out = f"({out} * {x} + CAST({coef!r} AS DOUBLE))"
        return out

    q, tail = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1.0 - {p})))"
    mid = f"(0.180625 - {q} * {q})"
    near, far = f"({tail} - 1.6)", f"({tail} - 5.0)"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {poly(_A, mid)} / {poly(_B, mid)} ELSE sign({q}) * CASE WHEN {tail}"
            f" <= 5 THEN {poly(_C, near)} / {poly(_D, near)} ELSE {poly(_E, far)} / {poly(_F, far)} END END")


def p_t_two_sided(t: Column, df: Column) -> Column:
    return _t2_udf(t.cast("double"), df.cast("double"))


def p_f(f: Column, d1: Column, d2: Column) -> Column:
    return _f_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))


def p_chi2(x: Column, k: Column) -> Column:
    return _chi2_udf(x.cast("double"), k.cast("double"))


def p_norm_two_sided(z: Column) -> Column:
    return _norm2_udf(z.cast("double"))


def p_norm_upper(z: Column) -> Column:
    return _normsf_udf(z.cast("double"))
