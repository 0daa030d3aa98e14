"""Sharding by vector bin packing.

Equal texts form a group, which is never parted.  Every group has a vector:
bytes, tokens (words) and rows, each as a share of the corpus.  A group goes
to the shard whose residual capacity has the highest dot product with its
vector, large groups first.

One packer cannot see all groups of a large corpus, so the packing is done
in two steps.  Groups that hold more than 1 / HEAVY of the bytes, tokens or
rows are fewer than 3 * HEAVY; they are packed first, on the driver.  The
other groups are dealt by hash over packers of about GROUPS_PER_PACKER, and each
packs its own into what the heavy groups left of every shard, in proportion to
its share of the light groups.  Shards then differ by about the
packers' smallest groups.

Slots are numbered without a window over a whole shard: rows are dealt by
a hash of doc_id over buckets, counted per (shard, bucket), and numbered inside
the bucket on top of the counts before it.

Defined results: a null text has 1 byte of size, checksum 0 and a group apart
from the empty text; repeated rows each have a slot of their own; with more
shards than groups some stay empty; an empty table gives an empty result; other
columns stay out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credspark.session import materialize

SHARDS = 16
HEAVY = 1024
GROUPS_PER_PACKER = 50_000
ROWS_PER_BUCKET = 100_000


#: Weight of bytes, tokens and rows in the dot product.  Bytes and tokens lead: near equal sizes are the law.
WEIGHTS = np.array([1.0, 1.0, 0.1])


def pack(vectors: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each vector, given in the order of packing; ``residual`` (shards x dimensions) is used up.

    A dimension that has run out in a shard counts as nothing there (a group of
    a third of all rows must not keep bytes away for good); among shards with
    nothing left the least exceeded is next.  Ties go to the lowest shard.
    """
    out = np.empty(len(vectors), np.int32)
    for i, v in enumerate(vectors * WEIGHTS):
        out[i] = s = int(np.argmax(np.maximum(residual, 0) @ v + 1e-3 * (residual @ v)))
        residual[s] -= vectors[i]
    return out


def _ordered(sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Largest vectors first, ties by key: the same order on every run."""
    return np.lexsort((keys, -sizes.sum(axis=1)))


def groups_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.sum("words").alias("tokens"),
                                 F.count(F.lit(1)).alias("rows"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    words = F.length(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "")) + 1     # breaks between words, and one
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        words.cast("long").alias("words"), F.concat(F.col("text").isNull().cast("string"), F.md5(raw)).alias("g")))
    groups = materialize(groups_of(rows))
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"),
                       F.count(F.lit(1)).alias("groups")).first()
    whole = np.array([total["bytes"] or 1, total["tokens"] or 1, total["rows"] or 1], float)
    dims = ["bytes", "tokens", "rows"]

    is_heavy = F.lit(False)
    for c, t in zip(dims, whole):
        is_heavy = is_heavy | (F.col(c) * HEAVY > F.lit(float(t)))
    heavy = groups.filter(is_heavy).toPandas()      # fewer than 3 * HEAVY rows
    residual = np.full((shards, 3), 1.0 / shards)
    vectors = heavy[dims].to_numpy(float) / whole
    order = _ordered(vectors, heavy["g"].to_numpy(str))
    placed = pack(vectors[order], residual)
    spark = docs.sparkSession
    fixed = spark.createDataFrame([(g, int(s)) for g, s in zip(heavy["g"].to_numpy(str)[order], placed)],
                                  "g string, shard int")

    light_share = np.maximum(1.0 - vectors.sum(axis=0), 1e-12)
    packers = max(1, math.ceil((total["groups"] or 0) / GROUPS_PER_PACKER))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(parts)
        if not got:
            return
        mine = pd.concat(got, ignore_index=True)
        v = mine[dims].to_numpy(float) / whole
        order = _ordered(v, mine["g"].to_numpy(str))
        left = residual * (v.sum(axis=0) / light_share)
        yield pd.DataFrame({"g": mine["g"].to_numpy()[order], "shard": pack(v[order], left)})

    light = (groups.filter(~is_heavy).repartition(packers, "g")
             .mapInPandas(run, "g string, shard int"))
    light_rows = rows.join(F.broadcast(fixed.select("g")), "g", "left_anti").join(light, "g")
    heavy_rows = rows.join(F.broadcast(fixed), "g")
    both = materialize(light_rows.unionByName(heavy_rows).select("doc_id", "size", "text_crc32", "shard", "g"))
    return _with_slots(both, total["rows"] or 0).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _with_slots(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 in each shard."""
    buckets = max(1, math.ceil(n / ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "g"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("shard", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "g"))
    return (rows.withColumn("inside", inside).join(before, ["shard", "bucket"])
            .withColumn("slot", (F.col("before") + F.col("inside") - 1).cast("long")))
