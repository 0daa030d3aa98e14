"""Run log and model registry on a shared folder.

Runs are rows of a Parquet table (params, tags and metrics as maps),
appended per run; models are ``PipelineModel`` directories under
``<root>/models/<name>/<version>`` with a versions table beside them.
The root should be the shared folder the cluster names (see
``session.checkpoint_dir``), never a machine-local one.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("logged_at", T.TimestampType()),
])
VERSION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("path", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("registered_at", T.TimestampType()),
])


def _runs(root: str) -> str:
    return os.path.join(root, "runs")


def _versions(root: str) -> str:
    return os.path.join(root, "model_versions")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def log_run(spark: SparkSession, root: str, experiment: str, run_name: str, params: dict | None = None,
            metrics: dict | None = None, tags: dict | None = None, run_id: str | None = None) -> str:
    """Append one run record; returns its id."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, experiment, run_name, {k: str(v) for k, v in (params or {}).items()},
           {k: str(v) for k, v in (tags or {}).items()}, {k: float(v) for k, v in (metrics or {}).items()},
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(_runs(root))
    return run_id


def log_run_from_metrics(metrics_row: DataFrame, root: str, experiment: str, run_name: str,
                         params: dict | None = None, tags: dict | None = None) -> DataFrame:
    """Log a one-row metrics DataFrame (every numeric column a metric) without
    collecting it: the map is built by Spark and appended as a run row."""
    num = [f.name for f in metrics_row.schema.fields if isinstance(f.dataType, T.NumericType)]
    run_id = uuid.uuid4().hex
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in num]), F.array(*[F.col(c).cast("double") for c in num]))
    pmap = F.create_map(*[x for k, v in (params or {}).items() for x in (F.lit(k), F.lit(str(v)))]) if params \
        else F.create_map().cast("map<string,string>")
    tmap = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(str(v)))]) if tags \
        else F.create_map().cast("map<string,string>")
    row = metrics_row.select(F.lit(run_id).alias("run_id"), F.lit(experiment).alias("experiment"),
                             F.lit(run_name).alias("run_name"), pmap.alias("params"), tmap.alias("tags"),
                             m.alias("metrics"), F.current_timestamp().cast("timestamp").alias("logged_at"))
    row.write.mode("append").parquet(_runs(root))
    return read_runs(metrics_row.sparkSession, root).filter(F.col("run_id") == run_id)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(_runs(root))


def runs_leaderboard(runs: DataFrame, metrics: list[str], order_by: str, ascending: bool = True) -> DataFrame:
    """One row per run, one column per metric, best first."""
    long = runs.select("run_id", "run_name", F.explode("metrics").alias("metric", "value")) \
        .filter(F.col("metric").isin(metrics))
    wide = long.groupBy("run_id", "run_name").pivot("metric", metrics).agg(F.first("value"))
    key = F.col(order_by).asc_nulls_last() if ascending else F.col(order_by).desc_nulls_last()
    return wide.orderBy(key, "run_name")


def _claim_version(spark: SparkSession, root: str, name: str, above: int) -> int:
    """The next version number of ``name``, claimed for this writer alone.

    A writer puts a claim file of its own beside the versions and then looks: with no other claim or folder of that
    number there, it is the writer's; otherwise it takes its claim back and tries again.  Of two writers the later to
    look sees the earlier, so never two win, on any store whose listings show what was written before (an exclusive
    create would not do: not every file system has one).  Numbers of writers that never published are skipped."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "models", name))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    listing = lambda: [str(f.getPath().getName()) for f in fs.listStatus(folder)]
    while True:
        numbers = [int(n.split(".")[0]) for n in listing() if n.split(".")[0].isdigit()]
        version = max([above, *numbers]) + 1
        mine = f"{version}.{uuid.uuid4().hex}.claim"
        claim = spark._jvm.org.apache.hadoop.fs.Path(folder, mine)
        fs.create(claim, False).close()
        if not [n for n in listing() if n.split(".")[0] == str(version) and n != mine]:
            return version
        fs.delete(claim, False)
        time.sleep(random.uniform(0.0, 0.2))


def _publish(spark: SparkSession, root: str, row: tuple) -> None:
    """Add a row to the versions table as a file of its own, written aside and renamed into place: readers see all of
    it or nothing, and writers do not share a folder of work in progress."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    aside = os.path.join(root, "_publishing", uuid.uuid4().hex)
    spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1).write.parquet(aside)
    fs = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(_versions(root)))
    part = next(f.getPath() for f in fs.listStatus(path(aside)) if f.getPath().getName().startswith("part-"))
    if not fs.rename(part, path(os.path.join(_versions(root), f"part-{uuid.uuid4().hex}.parquet"))):
        raise OSError(f"version {row[1]} of {row[0]} could not be published")
    fs.delete(path(aside), True)


def register_model(model: PipelineModel, spark: SparkSession, root: str, name: str,
                   run_id: str | None = None) -> DataFrame:
    """Save a fitted pipeline as the next version of ``name``; returns the new version row.

    A number is claimed first, then the model is saved under it, and only then is
    the version listed.  A writer that
    fails in between leaves a claim and perhaps files, which no reader sees and
    the next writer passes over; two writers never get one number, and a stored
    version is never overwritten.  A versions table that cannot be read is an error."""
    vpath = _versions(root)
    listed = 0
    if _exists(spark, vpath):
        listed = spark.read.schema(VERSION_SCHEMA).parquet(vpath).filter(F.col("name") == name) \
            .agg(F.max("version")).first()[0] or 0
    version = _claim_version(spark, root, name, listed)
    path = os.path.join(root, "models", name, str(version))
    model.write().save(path)
    row = (name, version, path, run_id or "", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    _publish(spark, root, row)
    return spark.createDataFrame([row], VERSION_SCHEMA)


def model_versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(VERSION_SCHEMA).parquet(_versions(root))


def resolve_model_version(versions: DataFrame, version: str | int = "latest") -> DataFrame:
    """Per name: the latest version, a given version number, or the version
    logged by a given run id -> (name, version, path, run_id)."""
    if version == "latest":
        return versions.groupBy("name").agg(F.max("version").alias("version"),
                                            F.max_by("path", "version").alias("path"),
                                            F.max_by("run_id", "version").alias("run_id"))
    if isinstance(version, int) or str(version).isdigit():
        return versions.filter(F.col("version") == int(version)).select("name", "version", "path", "run_id")
    w = Window.partitionBy("name").orderBy(F.desc("version"))
    return versions.filter(F.col("run_id") == str(version)).withColumn("_r", F.row_number().over(w)) \
        .filter("_r = 1").select("name", "version", "path", "run_id")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def export_models(spark: SparkSession, root: str, names: list[str], dest: str) -> DataFrame:
    """Copy the latest version of each model to ``dest/<name>``."""
    latest = resolve_model_version(model_versions(spark, root).filter(F.col("name").isin(names)))
    rows = latest.collect()  # one row per model name
    out = []
    for r in rows:
        target = os.path.join(dest, r["name"])
        load_model(r["path"]).write().overwrite().save(target)
        out.append((r["name"], r["version"], target))
    return spark.createDataFrame(out, "name string, version int, path string")


def write_ensemble_config(spark: SparkSession, path: str, weights: list[float], threshold: float,
                          components: list[str]) -> str:
    cfg = {"weights": [float(w) for w in weights], "threshold": float(threshold), "component_models": components}
    spark.createDataFrame([(json.dumps(cfg),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_ensemble_config(spark: SparkSession, path: str) -> DataFrame:
    """(position, component, weight, threshold) from a JSON ensemble config."""
    cfg = spark.read.option("multiLine", True).schema(
        "weights array<double>, threshold double, component_models array<string>").json(path)
    return cfg.select(F.posexplode(F.arrays_zip("component_models", "weights")).alias("position", "z"), "threshold") \
        .select("position", F.col("z.component_models").alias("component"), F.col("z.weights").alias("weight"),
                "threshold")
