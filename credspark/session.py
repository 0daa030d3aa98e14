"""Session helpers.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``;
we read it from the session and only set our own where it is unset (tests,
local runs).  Lineage is cut with ``DataFrame.checkpoint()`` into that
folder, never with ``localCheckpoint``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "credspark", cpus: int | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan over at least two tasks for each core: a table that came in one small file would be
    one task, however much is computed for each row.  Larger scans are left as they are."""
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def compiled(spark: SparkSession) -> None:
    """Methods that the JVM would only interpret (over 8,000 bytes) are generated in parts instead."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder (reliable, eager)
    and continue from there: operators whose plan reads the same narrow input
    in several branches scan and compute it once, and a lost executor
    re-reads the files instead of recomputing the whole lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the one the session names, else a scratch one
    in local mode.  On a cluster an unnamed folder is an error: executors and
    driver would each write to a disk of their own."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="credspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder, for tables written between
    steps.  It lies in the application's own folder, which is deleted when the
    application ends."""
    home = f"{checkpoint_dir(spark).rstrip('/')}/credspark-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(home)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{home}/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: unlike after a
    checkpoint, Spark knows the table's size and can choose its joins by it."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
