"""Projections, filters and scalar feature expressions.

All operators are narrow: column expressions in a ``select`` that Catalyst
collapses into one projection inside whole-stage codegen.  Nothing here
shuffles except ``detect_column_kinds`` / ``quantile_bins`` (a one-row
aggregate) and ``random_sample`` (a TakeOrdered top-k).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credspark import constants as K
from credspark.functions.hashing import md5_bucket

# ---------------------------------------------------------------- decoding


def decode_codes(df: DataFrame, codebook: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Map codes to labels for every column in the code book; unmapped values are kept.

    The code book is a literal map per column (tens of entries), so this is a
    pure projection: no join, no broadcast, no shuffle.
    """
    codebook = codebook or K.CODEBOOK
    out = []
    for c in df.columns:
        if c in codebook:
            m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codebook[c].items()))
            out.append(F.coalesce(m[F.col(c)], F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def cast_numeric_strict(df: DataFrame, columns: list[str] | None = None, to: str = "bigint") -> DataFrame:
    """Cast columns to integers; a malformed value raises (ANSI cast)."""
    columns = [c for c in (columns or K.NUMERIC_COLUMNS) if c in df.columns]
    return df.select(*[F.col(c).cast(to).alias(c) if c in columns else F.col(c) for c in df.columns])


def target_recode(df: DataFrame, column: str = K.TARGET) -> DataFrame:
    """Raw class code 1 (good) -> 1, 2 (bad) -> 0; anything else kept as NULL-free raw int."""
    v = F.col(column).cast("string")
    expr = F.when(v == "1", 1).when(v == "2", 0).otherwise(F.col(column).cast("int"))
    return df.withColumn(column, expr.cast("int"))


def drop_if_exists(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*(columns or K.DROP_COLUMNS))


def duplicate_columns(df: DataFrame, pairs: dict[str, str] | None = None) -> DataFrame:
    pairs = pairs or {"checking_2": "checking_account_status", "personal_status_2": "personal_status_sex"}
    return df.select("*", *[F.col(src).alias(dst) for dst, src in pairs.items()])


def equality_flag(df: DataFrame, column: str = "checking_account_status",
                  value: str = "no checking account", name: str = "no_checking") -> DataFrame:
    return df.withColumn(name, (F.col(column) == F.lit(value)).cast("int"))


# ------------------------------------------------------- numeric features

def _d(c: str) -> Column:
    return F.col(c).cast("double")


def feature_exprs(duplicate_checking: bool = False) -> dict[str, Column]:
    """Engineered columns as expressions over the *decoded* record."""
    amount, duration, age = _d("credit_amount"), _d("duration_months"), _d("age_years")
    burden = F.try_divide(amount, duration)
    ratio = F.try_divide(duration, age)
    e = {}
    if duplicate_checking:
        e["checking_2"] = F.col("checking_account_status")
        e["personal_status_2"] = F.col("personal_status_sex")
    e["no_checking"] = (F.col("checking_account_status") == "no checking account").cast("int")
    e["credit_amount_squared"] = amount * amount
    e["duration_squared"] = duration * duration
    e["monthly_burden"] = burden
    e["duration_to_age_ratio"] = ratio
    e["duration_to_age_ratio_sqrt"] = F.sqrt(ratio)
    e["credit_log"] = F.log1p(amount)
    e["duration_log"] = F.log1p(duration)
    # ln(0) is -inf in numpy; Spark gives NULL.  Kept NULL (documented).
    e["monthly_burden_log"] = F.ln(burden)
    return e


def square_features(df: DataFrame) -> DataFrame:
    e = feature_exprs()
    return df.select("*", e["credit_amount_squared"].alias("credit_amount_squared"),
                     e["duration_squared"].alias("duration_squared"))


def ratio_features(df: DataFrame) -> DataFrame:
    e = feature_exprs()
    return df.select("*", e["monthly_burden"].alias("monthly_burden"),
                     e["duration_to_age_ratio"].alias("duration_to_age_ratio"))


def log_sqrt_features(df: DataFrame) -> DataFrame:
    e = feature_exprs()
    names = ["credit_log", "duration_log", "monthly_burden_log", "duration_to_age_ratio_sqrt"]
    return df.select("*", *[e[n].alias(n) for n in names])


# ------------------------------------------------------ categorical merges

def merge_expr(column: str, merges=None) -> Column:
    merges = [m for m in (merges or K.CATEGORY_MERGES) if m[0] == column]
    out = F.col(column)
    for _, olds, new in merges:
        out = F.when(out.isin(olds), F.lit(new)).otherwise(out)
    return out


def merge_categories(df: DataFrame, merges=None) -> DataFrame:
    merges = merges or K.CATEGORY_MERGES
    cols = {m[0] for m in merges}
    return df.select(*[merge_expr(c, merges).alias(c) if c in cols else F.col(c) for c in df.columns])


def bin_expr(column: str, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins (lo, hi]; outside every bin gives NULL (as pd.cut)."""
    x = F.col(column)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def bin_right_closed(df: DataFrame) -> DataFrame:
    return df.select("*",
                     bin_expr("credit_amount", K.AMOUNT_EDGES, K.AMOUNT_LABELS).alias("credit_amount_bins"),
                     bin_expr("age_years", K.AGE_EDGES, K.AGE_LABELS).alias("age_group"))


def quantile_bins(df: DataFrame, column: str, q: int = 5, name: str | None = None) -> DataFrame:
    """Equal-frequency bins (pd.qcut contract): edges from exact quantiles,
    first bin closed on the left.  The edges are a one-row aggregate joined
    back as a broadcast (size bound: one row)."""
    from credspark.operators.profile import exact_quantiles

    name = name or f"{column}_q{q}"
    probs = [i / q for i in range(1, q)]
    names = [f"_e{i}" for i in range(1, q)]
    values = df.select(F.col(column).cast("double").alias("value")).dropna()
    edges = exact_quantiles(values, probs, [], names=names).select(F.array(*names).alias("_e"))
    x = F.col(column)
    out = F.when(x <= F.col("_e")[0], F.lit("Q1"))
    for i in range(1, q - 1):
        out = out.when(x <= F.col("_e")[i], F.lit(f"Q{i + 1}"))
    out = out.when(x.isNotNull(), F.lit(f"Q{q}"))
    return df.crossJoin(F.broadcast(edges)).withColumn(name, out).drop("_e")


# ------------------------------------------------------- feature engineer

def feature_engineer(df: DataFrame, duplicate_checking: bool = False) -> DataFrame:
    """All engineering steps in one projection (same column order as the
    source engineer: kept inputs, duplicates, flags and numeric features,
    merged categories in place, bins appended)."""
    e = feature_exprs(duplicate_checking)
    merged = {m[0] for m in K.CATEGORY_MERGES}
    kept = [c for c in df.columns if c not in K.DROP_COLUMNS]
    cols = [merge_expr(c).alias(c) if c in merged else F.col(c) for c in kept]
    cols += [v.alias(k) for k, v in e.items()]
    cols.append(bin_expr("credit_amount", K.AMOUNT_EDGES, K.AMOUNT_LABELS).alias("credit_amount_bins"))
    cols.append(bin_expr("age_years", K.AGE_EDGES, K.AGE_LABELS).alias("age_group"))
    return df.select(*cols)


# ------------------------------------------------------ kinds and domains

_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                  T.DoubleType, T.DecimalType)


def detect_column_kinds(df: DataFrame, columns: list[str] | None = None,
                        max_levels: int = 10, approx: bool = False) -> DataFrame:
    """(column, dtype, n_unique, kind): strings are categorical; numeric columns
    with at most ``max_levels`` distinct values are treated as categorical.
    One aggregate pass for all columns (approximate distinct for wide data)."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    cnt = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[cnt(F.col(f.name)).alias(f.name) for f in fields])
    stack = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', "
                      f"{'true' if isinstance(f.dataType, _NUMERIC_TYPES) else 'false'}, "
                      f"cast(`{f.name}` as bigint)" for f in fields)
    long = row.selectExpr(f"stack({len(fields)}, {stack}) as (column_name, dtype, is_numeric, n_unique)")
    kind = F.when(F.col("is_numeric") & (F.col("n_unique") > max_levels), "numerical").otherwise("categorical")
    return long.select("column_name", "dtype", "n_unique", kind.alias("kind"))


def pairwise_complete(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.dropna(subset=[a, b])


def validate_domain(df: DataFrame, categorical: dict[str, list[str]] | None = None,
                    numeric: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Per column: rows outside the declared categories or ranges.

    One aggregate pass with a conditional count per column (no explode, no
    join): (column, n_checked, n_invalid, invalid_pct)."""
    if categorical is None:
        categorical = {c: list(v.values()) for c, v in K.CODEBOOK.items()}
    numeric = numeric if numeric is not None else K.NUMERIC_DOMAIN
    checks = []
    for c, allowed in categorical.items():
        if c in df.columns:
            checks.append((c, F.col(c).isNotNull() & ~F.col(c).isin(allowed)))
    for c, (lo, hi) in numeric.items():
        if c in df.columns:
            checks.append((c, (F.col(c) < lo) | (F.col(c) > hi)))
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(F.when(cond, 1).otherwise(0)).alias(f"_bad_{i}") for i, (_, cond) in enumerate(checks)]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `_bad_{i}`" for i, (c, _) in enumerate(checks))
    long = row.selectExpr("_n", f"stack({len(checks)}, {stack}) as (column_name, n_invalid)")
    return long.select("column_name", F.col("_n").alias("n_checked"), F.col("n_invalid").cast("bigint"),
                       F.round(F.try_divide(F.col("n_invalid") * 100.0, F.col("_n")), 6).alias("invalid_pct"))


def invalid_rows(df: DataFrame, categorical=None, numeric=None, id_col: str = K.ROW_ID) -> DataFrame:
    """The offending (row id, column, value) triples, for inspection."""
    if categorical is None:
        categorical = {c: list(v.values()) for c, v in K.CODEBOOK.items()}
    numeric = numeric if numeric is not None else K.NUMERIC_DOMAIN
    parts = []
    for c, allowed in categorical.items():
        if c in df.columns:
            parts.append(df.filter(F.col(c).isNotNull() & ~F.col(c).isin(allowed))
                         .select(id_col, F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
    for c, (lo, hi) in numeric.items():
        if c in df.columns:
            parts.append(df.filter((F.col(c) < lo) | (F.col(c) > hi))
                         .select(id_col, F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def random_sample(df: DataFrame, n: int = 1, seed: int = 42, label: int | None = None,
                  target: str = K.TARGET, id_col: str = K.ROW_ID) -> DataFrame:
    """n rows, all or of one class, ordered by a seeded md5 bucket of the row id.
    The limit *is* the feature here (a sampling operator): a TakeOrdered top-k."""
    src = df if label is None else df.filter(F.col(target) == label)
    key = md5_bucket(F.concat(F.lit(f"{seed}_"), F.col(id_col).cast("string")), 1_000_000)
    return src.withColumn("_k", key).orderBy("_k", id_col).limit(n).drop("_k")


def unpivot_record(df: DataFrame, id_col: str = K.ROW_ID, columns: list[str] | None = None,
                   labels: dict[str, str] | None = None) -> DataFrame:
    """Each record as (row id, feature label, value text) rows."""
    labels = labels or K.FEATURE_LABELS
    columns = columns or [c for c in K.COLUMNS if c != K.TARGET and c in df.columns]
    long = df.select(id_col, *[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([id_col], columns, "feature", "value")
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    return long.select(id_col, F.coalesce(m[F.col("feature")], F.col("feature")).alias("feature"), "value")
