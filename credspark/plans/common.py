"""Shared pieces of the query catalog: views, held-out side, rounding, SQL helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credspark.functions.hashing import duck_md5_bucket
from credspark.operators.splits import hash_split
from credspark.session import compiled, written
from credspark.sources.fixtures import applications, scored, with_views

DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def apps(spark: SparkSession, d: str) -> DataFrame:
    return applications(spark, d)


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Train side and held-out side of the applications, written once: encoders, fits, folds and scores read them
    again and again, and each would derive them from the tables anew."""
    compiled(spark)
    a = written(applications(spark, d, dealt=True), "applications")
    return train_side(a), held_out(a)


def held_out(df: DataFrame, test_size: float = 0.15) -> DataFrame:
    return hash_split(df, test_size).filter(F.col("split") == "test").drop("split")


def train_side(df: DataFrame, test_size: float = 0.15) -> DataFrame:
    return hash_split(df, test_size).filter(F.col("split") == "train").drop("split")


def scored_test(spark: SparkSession, d: str) -> DataFrame:
    return held_out(scored(spark, d))


# ---------------------------------------------------------------- SQL side

TEST_PRED = f"{duck_md5_bucket('CAST(row_id AS VARCHAR)')} < 150"
TRAIN_PRED = f"{duck_md5_bucket('CAST(row_id AS VARCHAR)')} >= 150"


def sql(select_sql: str) -> str:
    """Oracle SQL with ``applications``, ``scored``, ``app_test``,
    ``app_train`` and ``scored_test`` available as CTEs."""
    return with_views(
        f"""
, app_test AS (SELECT * FROM applications WHERE {TEST_PRED})
, app_train AS (SELECT * FROM applications WHERE {TRAIN_PRED})
, scored_test AS (SELECT * FROM scored WHERE {TEST_PRED})
{select_sql}""")


def r(expr: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits})"


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def qs(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
