"""Whitening of embeddings onto their leading principal components.

Entries become whole numbers (floor(SCALE * c) + SHIFT), so sums over all
vectors are exact.  One aggregate gives the sums of every dimension, a second
pass the covariance of the centred numbers (each task adds up its own, summed by
entry); the matrix is as wide as a vector, whatever the number of rows.  Its
leading eigenpairs come from contour integration (``feast.largest``) on the
driver.  A third pass takes every vector to its components, and a fourth
measures the covariance of what came out against the identity.

Left out: vectors that are null or hold null or non-finite entries (or entries
of more than 2^40, which the whole numbers' sums could not hold), empty ones, and
those whose length is not the most frequent one (ties: the longer).
Repeated rows are each returned, null ids too.  Directions without variance have
no component; a table of one vector, of equal vectors or of none gives no rows.
Where several eigenvalues are equal, any orthonormal choice among their
directions may come out, the same for all rows.  ``deviation`` is exact; where
it exceeds 63 bits, it is null.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import small_batches
from credspark.llm.feast import largest
from credspark.session import written

#: Entries in whole numbers; components returned at most; an entry's largest size.
SCALE, SHIFT, COMPONENTS, LARGEST = 64, 1_000_000, 32, 1 << 40


def whole_vectors(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x array<long>) of the usable vectors, written once, and their length (0: there are none)."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                      & (F.abs(v.cast("double")) < F.lit(float(LARGEST))))
    usable = embeddings.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    x = usable.select("vec_id", F.transform(c, lambda v: F.floor(v * SCALE) + F.lit(SHIFT)).alias("x"))
    x = written(x, "whitening")
    width = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (x.filter(F.size("x") == width["d"]), width["d"]) if width else (x, 0)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _summed(parts: DataFrame, d: int) -> np.ndarray:
    """Symmetric matrix from (i, row) parts: the i-th row's entries from i on, added up over the tasks."""
    out = np.zeros((d, d))
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in cells.collect():       # d (d + 1) / 2 cells, whatever the number of vectors
        out[r["i"], r["i"] + r["j"]] = out[r["i"] + r["j"], r["i"]] = r["v"]
    return out


def _upper(m: np.ndarray) -> pa.RecordBatch:
    d = len(m)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array([m[i, i:] for i in range(d)],
                                                                                  pa.list_(pa.float64()))], ["i", "row"])


def covariance(x: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the centred vectors."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            centred = centre(_matrix(b.column(0), d), n, sums)
            total += centred.T @ centred
        yield _upper(total)

    return _summed(x.select("x").mapInArrow(run, "i int, row array<double>"), d) / n


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n: whole parts are taken off before dividing, so that no digit is lost."""
    part = np.array([divmod(int(s), n) for s in sums])
    return (x - part[:, 0]) - part[:, 1] / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - sum)^2 for every row, exact; None beyond 63 bits."""
    most = int(np.abs(x).max(initial=0))
    if most * n < 2 ** 62:
        away = x * n - sums
        if x.shape[1] * int(np.abs(away).max(initial=0)) ** 2 < 2 ** 62:
            return (away * away).sum(axis=1).tolist()
    rows = (sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x)
    return [v if v < 2 ** 63 else None for v in rows]


def project(x: DataFrame, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(vec_id, deviation, white array<double>) for every vector."""
    d, onto = len(sums), vectors / np.sqrt(values)
    kind = x.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1), d)
            white = centre(m, n, sums) @ onto
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(deviations(m, n, sums), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * len(values), pa.int32()),
                                          pa.array(white.ravel()))], ["vec_id", "deviation", "white"])

    return x.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation bigint, white array<double>")


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of ``white`` minus the identity.

    Each task centres by its own mean; the means are centred in turn when the tasks are added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, total = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            if not len(w):
                continue
            own = w.mean(axis=0)
            gap, both = own - mean, count + len(w)
            total += (w - own).T @ (w - own) + np.outer(gap, gap) * (count * len(w) / both)
            mean, count = mean + gap * (len(w) / both), both
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), pa.array([mean.tolist()]),
                                          pa.array([total.ravel().tolist()])], ["count", "mean", "total"])

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        count, mean, total = 0, np.zeros(k), np.zeros(k * k)
        for c, m, t in zip(parts["count"], parts["mean"], parts["total"]):
            if c:
                gap, both = np.asarray(m) - mean, count + c
                total = total + np.asarray(t) + np.outer(gap, gap).ravel() * (count * c / both)
                mean, count = mean + gap * (c / both), both
        return pd.DataFrame({"count": [count], "mean": [mean.tolist()], "total": [total.tolist()]})

    schema = "count bigint, mean array<double>, total array<double>"
    sent = white.select("white").mapInArrow(run, schema)
    branch = F.spark_partition_id() % max(1, int(white.rdd.getNumPartitions() ** 0.5))
    sent = sent.withColumn("branch", branch).groupBy("branch").applyInPandas(merged, schema)
    total = np.asarray(merged(sent.toPandas())["total"][0]).reshape(k, k)      # one row for each branch
    return float(np.abs(total / n - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every vector and component."""
    small_batches(embeddings.sparkSession, 2000)
    x, d = whole_vectors(embeddings)
    kind = x.schema["vec_id"].dataType.simpleString()
    none = embeddings.sparkSession.createDataFrame(
        [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")
    if not d:
        return none
    found = x.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    found = found.orderBy("k").collect()    # one row for each dimension
    n, sums = found[0]["n"], np.array([r["s"] for r in found], np.int64)
    cov = covariance(x, n, sums)
    values, vectors = largest(cov, components)
    k = len(values)
    if not k:
        return none
    white = written(project(x, n, sums, values, vectors), "white")
    error = identity_error(white, n, k)
    share = F.array(*[F.lit(float(v)) for v in values / np.trace(cov)])
    return white.select("vec_id", "deviation", F.posexplode("white").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("c")].alias("explained"), F.lit(error).alias("identity_error"))
