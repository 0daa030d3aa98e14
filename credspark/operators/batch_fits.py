"""Many fits at once: Spark jobs side by side, and logistic regressions that share their passes.

``side_by_side`` submits independent Spark work from a few driver threads.
``logistic_many`` fits any number of L2 logistic regressions on one encoded
matrix by Newton's method: a pass over the rows gives the loss, gradient and
second derivatives of every model, as one partial sum for each task, and the
driver solves the small systems.  A search of many settings thus costs the
passes of one fit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partial sums that the driver adds up itself; with more tasks, tasks add them up in groups first.
DIRECT = 16
#: Bytes of partial sums of one task; more models than fit are taken in batches.
SUM_BYTES = 64 << 20
#: Rows whose second derivatives are summed at once: few enough to stay in a core's cache.
CHUNK = 1024


def side_by_side(spark: SparkSession, work: Callable, items: list, parallelism: int = 4) -> list:
    """``work(item)`` for every item, a few at a time, in order."""
    if len(items) <= 1 or parallelism <= 1:
        return [work(i) for i in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the double arrays that the tasks of ``parts`` sent as column ``sums`` (binary)."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(x) for x in rows["sums"]).tobytes()]})

    tasks = parts.rdd.getNumPartitions()
    if tasks > DIRECT:
        parts = parts.withColumn("branch", F.spark_partition_id() % math.isqrt(tasks)).groupBy("branch").applyInPandas(
            add, "sums binary")
    total = np.zeros(size)
    for row in parts.select("sums").collect():      # DIRECT rows at most, or the square root of the tasks
        total += np.frombuffer(row["sums"])
    return total


def logistic_many(rows: DataFrame, regs: list[float], weights: list[dict[int, float] | None], features: str = "x",
                  label: str = "class", passes: int = 60, tol: float = 1e-9) -> np.ndarray:
    """Coefficients (intercept last) of a logistic regression for every setting, as rows of one matrix.

    ``regs``: L2 penalty of each, on all but the intercept, against the mean weighted loss; ``weights``: its
    weight of each class (None: 1).  ``rows``: a written or cached table with an array<double> of features and a
    0/1 label.  A Newton step that raises the loss is halved."""
    first = rows.select(F.size(features).alias("d")).first()
    if first is None:
        raise ValueError("there are no rows to fit on")
    d = first["d"] + 1
    at_once = max(1, SUM_BYTES // (8 * (d * d + d + 2)))
    out = [_newton(rows.select(features, label), d, regs[k:k + at_once], weights[k:k + at_once], passes, tol)
           for k in range(0, len(regs), at_once)]
    return np.concatenate(out)


def _newton(rows: DataFrame, d: int, regs: list[float], weights: list, passes: int, tol: float) -> np.ndarray:
    n_models = len(regs)
    by_class = np.array([[(w or {}).get(c, 1.0) for c in (0, 1)] for w in weights])
    ridge = np.asarray(regs)[:, None] * np.append(np.ones(d - 1), 0.0)
    now, before = np.zeros((n_models, d)), np.zeros((n_models, d))
    best = np.full(n_models, np.inf)
    open_ = np.arange(n_models)
    step = np.zeros((n_models, d))
    for _ in range(passes):
        first, alike = _alike(now[open_], by_class[open_])
        own = len(open_) * (d + 2)
        total = summed(rows.mapInArrow(_derivatives(now[open_], by_class[open_], first), "sums binary"),
                       own + len(first) * d * d)
        curves = total[own:].reshape(len(first), d, d)
        still = []
        for k, part, shared in zip(open_, total[:own].reshape(-1, d + 2), alike):
            weight, loss, grad, hess = part[0], part[1], part[2:], curves[shared]
            loss = loss / weight + 0.5 * (ridge[k] * now[k] ** 2).sum()
            if loss > best[k] + 1e-12 * abs(best[k]):       # too far: half the way
                step[k] /= 2
                now[k] = before[k] + step[k]
                if np.abs(step[k]).max() > tol:
                    still.append(k)
                continue
            best[k], before[k] = loss, now[k]
            grad = grad / weight + ridge[k] * now[k]
            step[k] = -np.linalg.lstsq(hess / weight + np.diag(ridge[k]), grad, rcond=None)[0]
            if -grad @ step[k] > tol:       # twice the decrease that the step promises
                now[k] = before[k] + step[k]
                still.append(k)
        open_ = np.array(still, int)
        if not len(open_):
            break
    return before


def _alike(coefficients: np.ndarray, by_class: np.ndarray) -> tuple[list[int], list[int]]:
    """Models that stand for others with the same coefficients and weights (all that begin at 0, for one), and for
    every model the place of the one that stands for it."""
    first: dict[bytes, int] = {}
    place = [first.setdefault(c.tobytes() + w.tobytes(), len(first)) for c, w in zip(coefficients, by_class)]
    return [place.index(k) for k in range(len(first))], place


def _derivatives(coefficients: np.ndarray, by_class: np.ndarray, first: list[int]):
    """Of every model its weight, loss and gradient, then the second derivatives of the models ``first``."""
    n_models, d = coefficients.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, curves = np.zeros((n_models, d + 2)), np.zeros((len(first), d, d))
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False).astype(int)
            x = np.ones((len(y), d))
            x[:, :-1] = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), d - 1)
            z = x @ coefficients.T
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            loss = np.logaddexp(0, np.where(y[:, None] == 1, -z, z))
            w = by_class[:, y].T
            own[:, 0] += w.sum(axis=0)
            own[:, 1] += (w * loss).sum(axis=0)
            own[:, 2:] += (w * (p - y[:, None])).T @ x
            root = np.sqrt(w * p * (1 - p))
            for lo in range(0, len(x), CHUNK):
                part = x[lo:lo + CHUNK]
                for k, j in enumerate(first):
                    scaled = part * root[lo:lo + CHUNK, j, None]
                    curves[k] += scaled.T @ scaled      # symmetric: half the products
        sums = np.concatenate((own.ravel(), curves.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    return run


def margins(rows: DataFrame, coefficients: np.ndarray, keep: list[str], features: str = "x") -> DataFrame:
    """(``keep``, trial, score): the linear score of every row under every model."""
    names = [*keep, "trial", "score"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(len(keep)).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            z = x @ coefficients[:, :-1].T + coefficients[:, -1]
            at = pa.array(np.repeat(np.arange(b.num_rows), len(coefficients)))
            yield pa.RecordBatch.from_arrays(
                [*[c.take(at) for c in b.columns[:len(keep)]],
                 pa.array(np.tile(np.arange(len(coefficients)), b.num_rows), pa.int32()), pa.array(z.ravel())], names)

    return rows.select(*keep, features).mapInArrow(run, f"{fields}, trial int, score double")
