"""Scoring as Structured Streaming.

The reference scores batch files only.  Every fitted operator here is a
stateless projection (plus literal-map lookups), so the same code accepts
a streaming DataFrame: ``stream_transform`` applies any such function to a
``readStream`` source.  Scoring with three trained pipelines, whose
outputs are joined on the row id, runs per micro-batch in ``foreachBatch``
(batch joins inside a micro-batch, no stream-stream state).  Progress is
kept in a checkpoint folder on the shared file system, so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from credspark import constants as K


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_transform(stream: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a stateless DataFrame -> DataFrame function to a stream."""
    out = fn(stream)
    if not out.isStreaming:
        raise ValueError("the function did not keep the stream")
    return out


def run_to_sink(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True):
    """Write the stream to files; with ``available_now`` process what is there and stop."""
    w = stream.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    q = w.trigger(availableNow=True).start() if available_now else w.start()
    if available_now:
        q.awaitTermination()
    return q


def score_stream_with_models(spark: SparkSession, source: str, schema: T.StructType, models: dict,
                             sink: str, checkpoint: str, weights=None, threshold: float = K.ENSEMBLE_THRESHOLD,
                             available_now: bool = True):
    """Score each micro-batch with the trained models, soft-vote, threshold.

    Every batch has a folder of its own under ``sink`` (``batch_id=<n>``), which a
    replayed batch overwrites, so a restart writes nothing twice."""
    from credspark.operators.ensemble import predict_threshold, soft_vote
    from credspark.operators.models import score_models

    def batch(df: DataFrame, batch_id: int) -> None:
        scored = predict_threshold(soft_vote(score_models(models, df), weights), threshold)
        scored.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = read_stream(spark, source, schema).writeStream.foreachBatch(batch) \
        .option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True).start() if available_now else q.start()
    if available_now:
        q.awaitTermination()
    return q
