"""Logistic regressions on many parts of one table, each with encoders of its own, in passes that all share.

The fits of a learning curve or of a search over folds differ by the rows they learn from, by their penalty and
class weights, and by the encoders that those rows gave.  Every encoder of a pipeline (one-hot, WOE, target, count,
ordinal, scaler) is linear in the indicators of a column's levels and in the numbers, so ``code_rows`` writes one
table of level codes and numbers, and an encoder is a small matrix (``encoding``) made of statistics that one grouped
pass gives for all parts.  ``fit`` is Newton's method on all regressions at once; ``score`` gives their exact AUCs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators.batch_fits import SUM_BYTES, summed
from credspark.operators.encoders import KINDS, MAP_LEVELS, unseen_missing
from credspark.session import materialize, written

#: Scores of one fit and side that a task of ``score`` ranks, and scores that a task holds before it sends them on.
GROUP_ROWS, HELD_SCORES = 250_000, 1_000_000
#: Bins of the scores that the ranges are cut by, and rows whose indicators are made at once.
BINS, CHUNK = 4096, 2048
#: A regression whose promised decrease shrinks by less than this from pass to pass gets second derivatives of its own.
SLOW = 0.1
#: Numbers of a coded row at most, its indicators counted.
WIDEST = 1000


@dataclass
class Coded:
    """Rows as codes and numbers: columns ``part``, ``y``, then a code for each of ``cats`` and each of ``nums``.
    ``levels``: those of each category, a further code stands for a missing one.  ``n``, ``pos``, ``first``: of each
    category, by level and part.  ``rows``, ``good``: of each part.  ``moments``: mean, squared deviations, least and
    greatest of each number, by part."""
    table: DataFrame
    spec: dict
    cats: list[str]
    nums: list[str]
    levels: dict[str, list[str]]
    n: dict[str, np.ndarray]
    pos: dict[str, np.ndarray]
    first: dict[str, np.ndarray]
    rows: np.ndarray
    good: np.ndarray
    moments: dict[str, np.ndarray]

    def __post_init__(self):
        self.offsets = np.cumsum([0, *[len(self.levels[c]) + 1 for c in self.cats]])
        self.width = int(self.offsets[-1]) + len(self.nums) + 1
        every = np.ones(len(self.rows), bool)
        # numbers are centred for all regressions alike; each one's own scaler is part of its encoding
        self.centres = np.array([self.moment(c, every) for c in self.nums]).reshape(-1, 2)

    def moment(self, c: str, parts: np.ndarray) -> tuple[float, float]:
        """Mean and population deviation of a number over ``parts``; 1 where it does not vary."""
        some = parts & (self.rows > 0)
        n, (mean, squares, low, high) = self.rows[some], self.moments[c][:, some]
        m = float((n * mean).sum() / n.sum())
        s = math.sqrt(float((squares + n * (mean - m) ** 2).sum() / n.sum()))
        return m, s if s > 0 and low.min() < high.max() else 1.0


def code_rows(pipeline: Pipeline, df: DataFrame, parts: int, part: str = "part", label: str = K.TARGET) -> Coded | None:
    """``df``, whose ``part`` is 0 .. parts - 1, as the encoders of ``pipeline`` see it.  None where a category has too
    many levels for that, or a number is missing or none: then each fit needs its own encoded rows."""
    stages = pipeline.getStages()
    spec = json.loads(stages[-1].getOrDefault("spec"))
    cats = [c for k in ("onehot", *KINDS) for c in spec.get(k, [])]
    nums = [*spec.get("scale", []), *spec.get("passthrough", [])]
    if len(set(cats + nums)) < len(cats + nums):
        return None
    for st in stages[:-1]:
        df = st.transform(df)
    y, value = F.col(label).cast("int"), {c: F.col(f"`{c}`").cast("double") for c in nums}
    of = [x for c in nums for x in (F.avg(value[c]), F.var_pop(value[c]), F.min(value[c]), F.max(value[c]),
                                    F.count_if(value[c].isNull() | F.isnan(value[c])))]
    if not cats and not nums:
        return None
    sums = df.groupBy(part).agg(F.count(F.lit(1)), F.sum(y), F.count_if(F.coalesce(~y.isin(0, 1), F.lit(True))),
                                *of).collect()      # a row for each part
    rows, good, moments = np.zeros(parts), np.zeros(parts), {c: np.zeros((4, parts)) for c in nums}
    for p, n, pos, strange, *rest in sums:
        if strange or any(rest[4::5]) or not np.isfinite(np.array(rest, float)).all():
            return None
        rows[p], good[p] = n, pos
        for c, (mean, variance, low, high, _) in zip(nums, np.array(rest, float).reshape(-1, 5)):
            moments[c][:, p] = mean, variance * n, low, high
    if not rows.any():
        return None
    long = df.select(part, y.alias("_y"), F.col(K.ROW_ID).alias("_rid"),
                     *[F.col(f"`{c}`").cast("string").alias(c) for c in cats])
    stats = materialize(long.unpivot([part, "_y", "_rid"], cats, "column_name", "level").filter("level is not null")
                        .groupBy("column_name", "level", part).agg(F.count(F.lit(1)).alias("n"),
                                                                   F.sum("_y").alias("pos"), F.min("_rid").alias("first")))
    many = stats.groupBy("column_name").agg(F.count_distinct("level").alias("k")).collect()     # one for each column
    if any(r["k"] > MAP_LEVELS for r in many) or sum(r["k"] + 1 for r in many) > WIDEST:
        return None
    levels: dict[str, list[str]] = {c: [] for c in cats}
    found = stats.collect()       # at most MAP_LEVELS rows for each column and part
    for c, level in sorted({(r["column_name"], r["level"]) for r in found}):
        levels[c].append(level)
    place = {c: {v: i for i, v in enumerate(levels[c])} for c in cats}
    n, pos = ({c: np.zeros((len(levels[c]), parts)) for c in cats} for _ in range(2))
    first = {c: np.full((len(levels[c]), parts), np.inf) for c in cats}
    for r in found:
        c, at = r["column_name"], (place[r["column_name"]][r["level"]], r[part])
        n[c][at], pos[c][at], first[c][at] = r["n"], r["pos"], r["first"]

    def code(c: str):
        if not levels[c]:
            return F.lit(0)
        known = F.create_map(*[F.lit(x) for v, i in place[c].items() for x in (v, i)])
        return F.coalesce(F.try_element_at(known, F.col(f"`{c}`").cast("string")), F.lit(len(levels[c])))

    table = df.select(F.col(part).cast("int").alias("part"), y.alias("y"),
                      *[code(c).cast("short").alias(f"c{i}") for i, c in enumerate(cats)],
                      *[value[c].alias(f"x{i}") for i, c in enumerate(nums)])
    # rows of a part and class side by side: they are summed together
    table = written(table.sortWithinPartitions("part", "y"), "coded")
    return Coded(table, spec, cats, nums, levels, n, pos, first, rows, good, moments)


def encoding(x: Coded, parts: np.ndarray) -> np.ndarray:
    """The encoders fitted on the rows of ``parts`` (a mask), as a matrix from coded rows to encoded ones; its last
    column is the intercept.  The formulas are those of ``encoders``."""
    rows, good = x.rows[parts].sum(), x.good[parts].sum()
    prior, one = good / rows, x.width - 1
    out = []

    def column(at, values) -> None:
        out.append(np.zeros(x.width))
        out[-1][at] = values

    for k in ("onehot", "woe", "scale", "target", "count", "ordinal", "passthrough"):     # as the encoded rows have them
        for c in x.spec.get(k, []):
            if k in ("scale", "passthrough"):
                i = x.nums.index(c)
                centre, spread = x.centres[i]
                m, s = x.moment(c, parts) if k == "scale" else (0.0, 1.0)
                column([x.offsets[-1] + i, one], [spread / s, (centre - m) / s])
                continue
            at = x.offsets[x.cats.index(c)]
            n, pos, first = x.n[c][:, parts].sum(axis=1), x.pos[c][:, parts].sum(axis=1), x.first[c][:, parts].min(axis=1)
            seen = np.array(sorted(np.flatnonzero(n), key=lambda i: (first[i], x.levels[c][i])), int)
            if k == "onehot":
                for i in seen:
                    column(at + i, 1.0)
                continue
            unseen, missing = unseen_missing(k, prior)
            values = np.append(np.full(len(n), float(unseen)), missing)
            n, pos = n[seen], pos[seen]
            if k == "woe":
                v = np.log(((pos + 1) / (good + 2)) / ((n - pos + 1) / (rows - good + 2)))
                values[seen] = np.where(n == 1, 0.0, v)
            elif k == "target":
                w = 1 / (1 + np.exp(-(n - 20) / float(x.spec.get("target_smoothing", 1.0))))
                values[seen] = prior * (1 - w) + pos / n * w
            elif k == "count":
                values[seen] = n / rows
            else:
                values[seen] = np.arange(1, len(seen) + 1)
            column(slice(at, at + len(values)), values)
    column(one, 1.0)
    return np.array(out).T


def _runs(batches: Iterator[pa.RecordBatch], offsets: np.ndarray, centres: np.ndarray):
    """(part, y, rows of indicators and numbers) of the rows of one part and class that follow each other."""
    cats = len(offsets) - 1
    for b in batches:
        if not b.num_rows:
            continue
        part, y = b.column(0).to_numpy(), b.column(1).to_numpy()
        codes = [b.column(2 + i).to_numpy().astype(np.int64) + offsets[i] for i in range(cats)]
        nums = [(b.column(2 + cats + i).to_numpy() - m) / s for i, (m, s) in enumerate(centres)]
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (y[1:] != y[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(y)]):
            for at in range(lo, hi, CHUNK):
                to = min(at + CHUNK, hi)
                x = np.zeros((to - at, offsets[-1] + len(centres) + 1))
                row = np.arange(to - at)
                for c in codes:
                    x[row, c[at:to]] = 1.0
                for i, v in enumerate(nums):
                    x[:, offsets[-1] + i] = v[at:to]
                x[:, -1] = 1.0
                yield int(part[lo]), int(y[lo]), x


def _derivatives(x: Coded, now: np.ndarray, weights: np.ndarray, models: list[int]):
    """Of every regression its loss and gradient over the coded columns, then the second derivatives of ``models``."""
    offsets, centres, width, n_models = x.offsets, x.centres, x.width, len(now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, curves = np.zeros((n_models, width + 1)), np.zeros((len(models), width, width))
        for part, y, v in _runs(batches, offsets, centres):
            w = weights[:, part, y]
            some = np.flatnonzero(w)
            if not len(some):
                continue
            z = v @ now[some].T
            small = np.exp(-np.abs(z))
            loss = np.log(1 + small) + np.maximum(-z if y else z, 0)
            p = np.where(z >= 0, 1.0, small) / (1 + small)
            own[some, 0] += w[some] * loss.sum(axis=0)
            own[some, 1:] += w[some, None] * ((p - y).T @ v)
            for k, j in enumerate(models):
                if w[j]:
                    q = p[:, np.searchsorted(some, j)]
                    scaled = v * np.sqrt(q * (1 - q))[:, None]
                    curves[k] += w[j] * (scaled.T @ scaled)      # symmetric: half the products
        sums = np.concatenate((own.ravel(), curves.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    return run


def fit(x: Coded, maps: list[np.ndarray], regs: list[float], weights: np.ndarray) -> np.ndarray:
    """Coefficients over the coded columns of every regression of ``solve``, as rows."""
    return np.array([t @ c for t, c in zip(maps, solve(x, maps, regs, weights))])


def solve(x: Coded, maps: list[np.ndarray], regs: list[float], weights: np.ndarray, passes: int = 60, tol: float = 1e-11
          ) -> list[np.ndarray]:
    """Coefficients over the encoded columns of every regression, its intercept last.

    ``maps``: its encoding; ``regs``: its L2 penalty, on all encoded columns but the intercept, against the mean
    weighted loss; ``weights``: (regression, part, class), 0 for parts it does not learn from.

    Regressions with the same class weights begin with the second derivatives of the one of them with the most rows:
    on many rows they differ by chance only, and a step is right as long as it is taken from the regression's own
    gradient.  One that comes down slowly so gets its own.  A step that raises the loss is halved."""
    some = max(1, SUM_BYTES // (8 * (x.width + 1)))
    if len(maps) > some:
        return [c for k in range(0, len(maps), some)
                for c in solve(x, maps[k:k + some], regs[k:k + some], weights[k:k + some], passes, tol)]
    n_models = len(maps)
    counts = np.stack([x.rows - x.good, x.good], axis=1)        # (part, class)
    total = (weights * counts).sum(axis=(1, 2))
    ridge = [np.append(np.full(t.shape[1] - 1, r), 0.0) for t, r in zip(maps, regs)]
    kinds: dict[bytes, list[int]] = {}
    for k in range(n_models):       # weights of the classes against each other
        kinds.setdefault(np.round(weights[k].max(axis=0) / weights[k].max(), 1).tobytes(), []).append(k)
    like = np.empty(n_models, int)
    for same in kinds.values():
        like[same] = max(same, key=lambda k: ((weights[k] > 0) * counts).sum())
    now = [np.zeros(t.shape[1]) for t in maps]
    before, step = [c.copy() for c in now], [c.copy() for c in now]
    best, promised = np.full(n_models, np.inf), np.full(n_models, np.inf)
    open_ = list(range(n_models))
    most = max(1, SUM_BYTES // (8 * x.width ** 2))

    def sums_at(models: list[int], curved: list[int]) -> tuple[dict, dict]:
        """Loss and gradient of ``models``, and second derivatives of ``curved``, over the coded columns."""
        wanted = sorted({*models, *curved})
        size = len(wanted) * (x.width + 1)
        work = _derivatives(x, np.array([maps[k] @ now[k] for k in wanted]), weights[wanted],
                            [wanted.index(k) for k in curved])
        got = summed(x.table.mapInArrow(work, "sums binary"), size + len(curved) * x.width ** 2)
        return (dict(zip(wanted, got[:size].reshape(-1, x.width + 1))),
                dict(zip(curved, got[size:].reshape(-1, x.width, x.width))))

    for _ in range(passes):
        curved = sorted({like[k] for k in open_})
        sums, curves = sums_at(open_, curved[:most])
        for lo in range(most, len(curved), most):       # there are so many only where many need their own
            curves |= sums_at([], curved[lo:lo + most])[1]
        still = []
        for k in open_:
            loss = sums[k][0] / total[k] + 0.5 * (ridge[k] * now[k] ** 2).sum()
            if loss > best[k] + 1e-12 * abs(best[k]):       # too far: half the way
                like[k] = k
                step[k] = step[k] / 2
                now[k] = before[k] + step[k]
                if np.abs(step[k]).max() > tol:
                    still.append(k)
                continue
            best[k], before[k] = loss, now[k]
            grad = maps[k].T @ sums[k][1:] / total[k] + ridge[k] * now[k]
            hess = maps[k].T @ (curves[like[k]] / total[like[k]]) @ maps[k] + np.diag(ridge[k])
            step[k] = -np.linalg.lstsq(hess, grad, rcond=None)[0]
            decrease = float(-grad @ step[k])
            if decrease > tol:       # twice the decrease that the step promises
                if like[k] != k and decrease > SLOW * promised[k]:
                    like[k] = k
                promised[k] = decrease
                now[k] = before[k] + step[k]
                still.append(k)
        open_ = still
        if not open_:
            break
    return before


def _binned(x: Coded, coefficients: np.ndarray):
    """Rows by bins of the score of one regression."""
    offsets, centres = x.offsets, x.centres

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(BINS)
        for _, _, v in _runs(batches, offsets, centres):
            p = 1 / (1 + np.exp(-np.clip(v @ coefficients, -500, 500)))
            bins += np.bincount(np.minimum((p * BINS).astype(int), BINS - 1), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary())], ["sums"])

    return run


def score(x: Coded, coefficients: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """The exact ROC AUC of every regression on each of its sides (regression, side); NaN where a side lacks a class.
    ``sides``: (regression, part) holds the side that a part is on, -1 for none.

    Tasks sort the scores of a regression, side and class and send them, as they are, to the task of their range;
    ranges are cut by the scores of one regression, any cuts will do."""
    offsets, centres, n_sides = x.offsets, x.centres, int(sides.max()) + 1
    most = max((x.rows * (sides == s)).sum(axis=1).max() for s in range(n_sides))
    ranges = math.ceil(most / GROUP_ROWS)
    edges = np.empty(0)
    if ranges > 1:
        bins = summed(x.table.mapInArrow(_binned(x, coefficients[0]), "sums binary"), BINS).cumsum()
        edges = np.unique(np.searchsorted(bins, bins[-1] * np.arange(1, ranges) / ranges) / BINS)
    ranges = len(edges) + 1

    def packed(held: dict) -> pa.RecordBatch:
        keys, classes, values = [], [], []
        for (k, side, y), parts in held.items():
            v = np.sort(np.concatenate(parts))
            cuts = np.searchsorted(v, edges)
            for r, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(v)])):
                if a < b:
                    keys.append((k * n_sides + side) * ranges + r)
                    classes.append(y)
                    values.append(v[a:b].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(classes, pa.int32()),
                                           pa.array(values, pa.binary())], ["key", "y", "v"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {}, 0
        for part, y, v in _runs(batches, offsets, centres):
            some = np.flatnonzero(sides[:, part] >= 0)
            p = 1 / (1 + np.exp(-np.clip(coefficients[some] @ v.T, -500, 500)))
            for k, row in zip(some.tolist(), p):
                held.setdefault((k, int(sides[k, part]), y), []).append(row)
            n += p.size
            if n >= HELD_SCORES:
                yield packed(held)
                held, n = {}, 0
        if held:
            yield packed(held)

    def ranked(t: pa.Table) -> pa.Table:
        of = t.column("y").to_numpy()
        v = [np.sort(np.concatenate([np.empty(0), *[np.frombuffer(b.as_buffer()) for b, c in zip(t.column("v"), of)
                                                    if c == y]])) for y in (0, 1)]
        # pairs in order count 2, equal ones 1
        twice = int((np.searchsorted(v[0], v[1], "left") + np.searchsorted(v[0], v[1], "right")).sum())
        return pa.table({"key": t.column("key").slice(0, 1), "twice": [twice], "pos": [len(v[1])], "neg": [len(v[0])]})

    sums = x.table.mapInArrow(scored, "key long, y int, v binary").groupBy("key").applyInArrow(
        ranked, "key long, twice long, pos long, neg long").collect()       # a row for each regression, side and range
    by_range = np.zeros((3, len(sides) * n_sides, ranges))
    for r in sums:
        by_range[:, r["key"] // ranges, r["key"] % ranges] = r["twice"] / 2, r["pos"], r["neg"]
    won, pos, neg = by_range
    won = (won + pos * (np.cumsum(neg, axis=1) - neg)).sum(axis=1)
    pairs = pos.sum(axis=1) * neg.sum(axis=1)
    return np.where(pairs > 0, won / np.maximum(pairs, 1), np.nan).reshape(len(sides), n_sides)
