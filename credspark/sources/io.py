"""Sources and sinks for application records.

- ``read_coded_text``: whitespace-separated coded records, no header; blank
  lines skipped; the width is checked on *every* row by one aggregate (the
  source checked only the first); the row id is the line position, from
  running sums over the table of file blocks.
- ``read_csv_typed``: header CSV with quoted commas, fixed schema, FAILFAST.
- ``write_split``: partitioned write of a split table (parquet or CSV).
- ``class_head_sample`` / ``union_samples``: first n rows per class, stacked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credspark import constants as K
from credspark.operators.features import cast_numeric_strict, decode_codes, target_recode
from credspark.session import materialize, written


def parse_coded_lines(lines: DataFrame, names: list[str] | None = None, decode: bool = True) -> DataFrame:
    """Text lines (column ``value``, optionally ``_file`` / ``_block`` file
    positions) -> typed, decoded application rows with positional row ids.

    The lines are parsed once, into the shared folder, with their place in
    their partition; lines of one block stand there one after the other.  The
    table of blocks (one row per file block) then gives the width check and,
    by running sums in file order, each block's first row id: rows are never sorted."""
    names = names or K.COLUMNS
    if "_file" not in lines.columns:
        lines = lines.select("value", F.lit("").alias("_file"), F.spark_partition_id().cast("long").alias("_block"))
    place = F.expr("monotonically_increasing_id() & 8589934591")  # lower 33 bits: row within partition
    toks = written(lines.filter(F.trim("value") != "").select(
        "_file", "_block", place.alias("_in"), F.split(F.trim("value"), r"\s+").alias("_t")), "lines")
    width = F.size("_t")
    blocks = materialize(toks.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("n"), F.min("_in").alias("_first"), F.min(width).alias("lo"), F.max(width).alias("hi"),
        F.sum(F.when(width != len(names), 1).otherwise(0)).alias("bad")))
    chk = blocks.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("lo").alias("lo"),
                     F.max("hi").alias("hi")).first()
    if not chk["n"]:
        raise RuntimeError("no data rows found")
    if chk["bad"]:
        raise ValueError(f"expected {len(names)} columns, got rows with {chk['lo']} to {chk['hi']} "
                         f"({chk['bad']} bad rows)")
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per file block
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    rows = toks.join(starts, ["_file", "_block"])
    rows = rows.select((F.col("_start") + F.col("_in") - F.col("_first")).alias(K.ROW_ID),
                       *[F.col("_t")[i].alias(n) for i, n in enumerate(names)])
    if not decode:
        return rows
    return target_recode(cast_numeric_strict(decode_codes(rows)))


def read_coded_text(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                       F.col("_metadata.file_block_start").alias("_block"))
    return parse_coded_lines(raw, names)


def application_schema(with_id: bool = True) -> T.StructType:
    fields = [T.StructField(K.ROW_ID, T.LongType())] if with_id else []
    for c in K.COLUMNS:
        if c == K.TARGET:
            fields.append(T.StructField(c, T.IntegerType()))
        elif c in K.NUMERIC_COLUMNS:
            fields.append(T.StructField(c, T.IntegerType()))
        else:
            fields.append(T.StructField(c, T.StringType()))
    return T.StructType(fields)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with quoted fields (one label holds a comma); a value that
    does not fit the declared type fails the read."""
    return spark.read.csv(path, header=True, schema=schema or application_schema(), quote='"', escape='"',
                          mode="FAILFAST")


def write_split(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> str:
    w = df.write.mode("overwrite").partitionBy(split_col)
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.parquet(path)
    return path


def write_coded_text(df: DataFrame, path: str) -> str:
    """Encode decoded rows back to raw codes, one whitespace-separated line each."""
    parts = []
    for c in K.COLUMNS:
        if c in K.CODEBOOK:
            inv = F.create_map(*[x for code, lab in K.CODEBOOK[c].items() for x in (F.lit(lab), F.lit(code))])
            parts.append(F.coalesce(inv[F.col(c)], F.col(c)))
        elif c == K.TARGET:
            parts.append(F.when(F.col(c) == 1, "1").otherwise("2"))
        else:
            parts.append(F.col(c).cast("string"))
    df.orderBy(K.ROW_ID).select(F.concat_ws(" ", *parts).alias("value")).write.mode("overwrite").text(path)
    return path


def class_head_sample(df: DataFrame, n: int = 50, target: str = K.TARGET, id_col: str = K.ROW_ID) -> DataFrame:
    """First n rows (by row id) of each class, stacked.  Classes are few (a
    bounded collect); each head is a distributed top-n (TakeOrdered)."""
    classes = sorted(r[0] for r in df.select(target).distinct().collect())
    out = None
    for c in classes:
        h = df.filter(F.col(target) == c).orderBy(id_col).limit(n)
        out = h if out is None else union_samples(out, h)
    return out


def union_samples(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)
