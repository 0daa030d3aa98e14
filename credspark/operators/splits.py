"""Splitting, folds, class weights and split statistics.

``hash_split`` is a column expression (no shuffle).  Exact-size and fold
assignment need per-class row numbers; they use the bucketed running
totals of ``ranks`` so a class never sits in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.hashing import md5_bucket
from credspark.operators.ranks import row_numbers

HASH_KEY_MOD = 2147483647  # 2^31 - 1: a near-unique seeded order key


def hash_bucket_col(df: DataFrame, id_col: str = K.ROW_ID, hash_column: str | None = None, n: int = 1000):
    src = F.col(id_col).cast("string")
    if hash_column and hash_column in df.columns:
        src = F.concat(F.col(hash_column).cast("string"), F.lit("_"), src)
    return md5_bucket(src, n)


def hash_split(df: DataFrame, test_size: float = 0.15, id_col: str = K.ROW_ID,
               hash_column: str | None = None, name: str = "split") -> DataFrame:
    """Label each row 'test' when md5(row id) mod 1000 < int(test_size * 1000).

    The class plays no part in membership (one global threshold per class
    is the same threshold), so the split is one narrow projection."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    threshold = int(test_size * 1000)
    b = hash_bucket_col(df, id_col, hash_column)
    return df.withColumn(name, F.when(b < threshold, F.lit("test")).otherwise(F.lit("train")))


def train_test(df: DataFrame, test_size: float = 0.15, **kw) -> tuple[DataFrame, DataFrame]:
    s = hash_split(df, test_size, **kw)
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "test").drop("split"))


def split_stats(split_df: DataFrame, split_col: str = "split", target: str = K.TARGET) -> DataFrame:
    """(split, class, n, split_n, split_share, class_share_in_split)."""
    g = split_df.groupBy(split_col, target).agg(F.count(F.lit(1)).alias("n"))
    w_split = Window.partitionBy(split_col)
    w_all = Window.partitionBy()
    # g has (splits x classes) rows: tiny, a global window over it is fine.
    return g.select(
        split_col, target, "n",
        F.sum("n").over(w_split).alias("split_n"),
        F.round(F.sum("n").over(w_split) / F.sum("n").over(w_all), 6).alias("split_share"),
        F.round(F.col("n") / F.sum("n").over(w_split), 6).alias("class_share"),
    )


def class_distribution(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return g.select(target, "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def seeded_key(seed: int, id_col: str = K.ROW_ID):
    return md5_bucket(F.concat(F.lit(f"{seed}_"), F.col(id_col).cast("string")), HASH_KEY_MOD)


def _largest_remainder(counts: DataFrame, size, target: str) -> DataFrame:
    """Per class the number to take, n_c, summing exactly to the requested size."""
    w = Window.partitionBy()
    tot = F.sum("n").over(w)
    want = (F.lit(size) * 1.0) if isinstance(size, int) else F.ceil(F.lit(size) * tot)
    c = counts.select(target, "n", (want * F.col("n") / tot).alias("_exact"), want.cast("long").alias("_want"))
    c = c.select("*", F.floor("_exact").cast("long").alias("_base"),
                 (F.col("_exact") - F.floor("_exact")).alias("_rem"))
    c = c.select("*", (F.col("_want") - F.sum("_base").over(w)).alias("_left"),
                 F.row_number().over(Window.orderBy(F.desc("_rem"), target)).alias("_pos"))
    return c.select(target, (F.col("_base") + F.when(F.col("_pos") <= F.col("_left"), 1).otherwise(0)).alias("n_take"))


def stratified_split(df: DataFrame, size: int | float = 150, seed: int = 8,
                     target: str = K.TARGET, id_col: str = K.ROW_ID, name: str = "split") -> DataFrame:
    """Exact-size 'val' side with class shares kept (largest remainder),
    rows of each class taken in seeded-hash order; the rest is 'fit'."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    take = F.broadcast(_largest_remainder(counts, size, target))  # one row per class
    keyed = df.withColumn("_key", seeded_key(seed, id_col))
    rn = row_numbers(keyed, "_key", [target], tie_cols=[id_col], name="_rn", uniform_below=HASH_KEY_MOD)
    out = rn.join(take, on=target, how="left")
    return out.withColumn(name, F.when(F.col("_rn") <= F.col("n_take"), "val").otherwise("fit")) \
        .drop("_key", "_rn", "n_take")


def kfold_assign(df: DataFrame, k: int = 5, seed: int = 8, target: str = K.TARGET,
                 id_col: str = K.ROW_ID, name: str = "fold") -> DataFrame:
    """Stratified folds: per-class row number in seeded-hash order, mod k.
    Fold sizes within a class differ by at most one."""
    keyed = df.withColumn("_key", seeded_key(seed, id_col))
    rn = row_numbers(keyed, "_key", [target], tie_cols=[id_col], name="_rn", uniform_below=HASH_KEY_MOD)
    return rn.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_key", "_rn")


def class_weights(df: DataFrame, weights: dict | str | None = "balanced", target: str = K.TARGET) -> DataFrame:
    """(class, weight): explicit, or 'balanced' n / (n_classes * n_c)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    if weights == "balanced":
        w = Window.partitionBy()
        return counts.select(target, "n", (F.sum("n").over(w) / (F.count("n").over(w) * F.col("n")))
                             .alias("weight"))
    weights = weights or {}
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]) if weights else None
    wcol = F.coalesce(m[F.col(target)], F.lit(1.0)) if m is not None else F.lit(1.0)
    return counts.select(target, "n", wcol.alias("weight"))


def with_weights(df: DataFrame, weights: dict | str | None = "balanced", target: str = K.TARGET,
                 name: str = "weight") -> DataFrame:
    """Attach a weight column for ``weightCol`` (broadcast: one row per class)."""
    cw = F.broadcast(class_weights(df, weights, target).select(target, F.col("weight").alias(name)))
    return df.join(cw, on=target, how="left")
