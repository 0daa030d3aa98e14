"""Class rebalancing: SMOTE and SVM-SMOTE.

Input: rows with ``row_id``, ``class`` and an encoded ``features`` vector
(categories must be encoded first, as the pipelines do).  Output: the input
rows plus synthetic minority rows (``synthetic`` = 1, negative row ids).

Neighbour search is exact: reference rows (the minority, or all rows for
SVM-SMOTE's danger test) are dealt to cells by median splits, and a query is
compared, by matrix products, only with the cells whose boxes are near enough.
Only the k best per query leave a task; no pair is written out.

Synthesis is seeded and distributed: synthetic row s picks its base row by
position (distributed row numbers) from a seeded hash of s, one of the
base's k neighbours and a gap u in [0, 1) from further hashes, then
x_new = x + step * u * (x_nbr - x) with array expressions (Chawla 2002;
Nguyen, Cooper & Kamei 2009 for the SVM variant).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.hashing import md5_bucket
from credspark.operators.models import gathered
from credspark.operators.ranks import row_numbers
from credspark.session import materialize, written

#: Distinct reference vectors of one block of a cell, leaves at most, and vectors of a leaf where there are fewer.
BLOCK_ROWS, PIVOTS, LEAF_ROWS = 5000, 4096, 256
#: Query vectors that meet a block in one task, and the sample for the splits (it reaches the driver): rows, numbers.
QUERY_ROWS, SAMPLE, SAMPLE_VALUES = 8192, 16384, 2_000_000
#: Slack on distances, and of a matrix product's, so that rounding never prunes a neighbour.
SLACK, ROUNDING = 1e-9, 1e-10
U_MOD = 2147483647
NEAR = "array<struct<d:double,id:long,label:int>>"


def _as_array(df: DataFrame, features: str = "features") -> DataFrame:
    return df.select(K.ROW_ID, K.TARGET, vector_to_array(F.col(features)).alias("x"))


def _matrix(t: pa.Table, name: str) -> np.ndarray:
    """A column of vectors as one matrix."""
    flat = t.column(name).combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(t.num_rows, -1)


def _pairs(q: np.ndarray, m: np.ndarray, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, reference, squared distance) of all pairs that may be among a query's k nearest and are not beyond
    its squared ``reach``.  A matrix product finds them, with room for its rounding; their distances are then
    summed difference by difference, so that equal rows are at distance 0 exactly."""
    room = ROUNDING * (np.einsum("ij,ij->i", q, q) + np.einsum("ij,ij->i", m, m).max(initial=0))
    rough = np.einsum("ij,ij->i", q, q)[:, None] + np.einsum("ij,ij->i", m, m) - 2 * (q @ m.T)
    most = reach.copy()
    if len(m) > k:      # k references are surely within the k-th rough distance and its rounding
        most = np.fmin(most, np.partition(rough, k - 1, axis=1)[:, k - 1])
    i, j = np.nonzero(rough <= (most + room)[:, None])
    d = np.zeros(len(i))
    for c in range(m.shape[1]):
        diff = q[i, c] - m[j, c]
        d += diff * diff
    return i, j, d


def _nearest(q: pa.Table, ref: pa.Table, k: int) -> pa.Table:
    """(qkey, near): the k nearest (by distance, then id) among the ids of one block of reference vectors, for every
    query vector, as far as its ``reach``.  The block is gone through by leaves, whose boxes spare most pairs."""
    kind = pa.struct([("d", pa.float64()), ("id", pa.int64()), ("label", pa.int32())])
    out = pa.schema([("qkey", pa.int64()), ("near", pa.list_(kind))])
    if not q.num_rows or not ref.num_rows:
        return out.empty_table()
    ref = ref.sort_by("leaf")
    x, m, leaf = _matrix(q, "qx"), _matrix(ref, "rx"), ref.column("leaf").to_numpy()
    ids = ref.column("ids").combine_chunks()
    entry = ids.flatten()
    each, label = entry.field("id").to_numpy(zero_copy_only=False), entry.field("label").to_numpy(zero_copy_only=False)
    size = np.diff(ids.offsets.to_numpy())
    begin = np.cumsum(size) - size
    starts = np.flatnonzero(np.concatenate(([True], leaf[1:] != leaf[:-1])))
    ends = np.append(starts[1:], len(leaf))
    low, high = np.minimum.reduceat(m, starts), np.maximum.reduceat(m, starts)
    reach = q.column("reach").fill_null(np.inf).to_numpy()
    kept = []
    for lo in range(0, len(x), 512):
        part, limit = x[lo:lo + 512], reach[lo:lo + 512] * (1 + SLACK)
        found = []
        if np.isfinite(limit).all():
            gap = _box_distance(part, low, high) * (1 - SLACK)
            for f in range(len(starts)):
                mine = np.flatnonzero(gap[:, f] <= limit)
                if len(mine):
                    i, j, d = _pairs(part[mine], m[starts[f]:ends[f]], k, limit[mine])
                    found.append((mine[i], j + starts[f], d))
        else:
            found.append(_pairs(part, m, k, limit))
        if not found:
            continue
        i, j, d = (np.concatenate(v) for v in zip(*found))
        times = size[j]     # each vector has an id at least: the nearest k vectors and their ties suffice
        at = np.repeat(begin[j] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        i, d = np.repeat(i, times), np.repeat(d, times)
        order = np.lexsort((each[at], d, i))
        i, d, at = i[order], d[order], at[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        few = nth < k
        kept.append((i[few] + lo, d[few], at[few]))
    if not kept:
        return out.empty_table()
    i, d, at = (np.concatenate(v) for v in zip(*kept))
    who, first = np.unique(i, return_index=True)
    near = pa.ListArray.from_arrays(pa.array(np.append(first, len(i)), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(d), pa.array(each[at], pa.int64()), pa.array(label[at], pa.int32())], fields=list(kind)))
    return pa.table([q.column("qkey").to_numpy()[who], near], schema=out)


def _box_distance(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every box.  A column that lies within a box for all rows adds nothing."""
    out = np.zeros((len(low), len(x)))
    if not len(x):
        return out.T
    away = ~((low <= x.min(axis=0)) & (high >= x.max(axis=0)))
    for c in np.flatnonzero(away.any(axis=0)):
        some = np.flatnonzero(away[:, c])
        v = x[:, c]
        gap = np.maximum(low[some, c, None] - v, v - high[some, c, None])
        np.maximum(gap, 0, out=gap)
        gap *= gap
        out[some] += gap
    return out.T


#: Columns that tell vectors apart: the group and 128 bits of the vector (an array as the key of a join or a group is
#: compared, and its zeros and NaNs levelled, number by number).
VECTOR = ["g", "key"]


def _keys(x: pa.ListArray) -> pa.Array:
    """The digest of every vector; zeros of both signs are equal, and all entries that are no number."""
    if x.null_count:
        raise ValueError("a row without a vector has no neighbours")
    flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
    flat[np.isnan(flat)] = np.nan
    ends, raw = (x.offsets.to_numpy() - x.offsets[0].as_py()) * 8, flat.tobytes()
    return pa.array([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:])], pa.binary())


def _keyed(df: DataFrame, x: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the ``key`` of the vectors ``x``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], _keys(b.column(0))], [*keep, "key"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(x, *keep).mapInArrow(run, f"{fields}, key binary")


def distinct_vectors(df: DataFrame, keep: int) -> DataFrame:
    """(g, key, rx, ids): the distinct vectors of each group with their ``keep`` smallest ids, which are all that any
    query's nearest rows can take from equal vectors.  Tasks cut their own rows first, so a vector held by a third
    of the rows arrives as a few ids from each."""
    kind = pa.struct([("id", pa.int64()), ("label", pa.int32())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).append_column("key", _keys(b.column(1)))
            t = t.take(pc.sort_indices(t.select([*VECTOR, "id"]), [(c, "ascending") for c in (*VECTOR, "id")],
                                       null_placement="at_start"))
            g, key = (t.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in VECTOR)
            first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (key[1:] != key[:-1]))))
            few = np.minimum(np.diff(np.append(first, len(key))), keep)
            begin = np.cumsum(few) - few
            kept = t.select(["id", "label"]).take(np.repeat(first - begin, few) + np.arange(int(few.sum())))
            ids = pa.StructArray.from_arrays([kept.column(c).combine_chunks().cast(kind.field(c).type)
                                              for c in ("id", "label")], fields=list(kind))
            out = t.select([*VECTOR, "rx"]).take(first).append_column(
                "ids", pa.ListArray.from_arrays(pa.array(np.append(begin, few.sum()), pa.int32()), ids))
            yield from out.combine_chunks().to_batches()

    one = "array<struct<id:long,label:int>>"
    mine = df.select("g", "rx", "id", "label").mapInArrow(cut, f"g string, key binary, rx array<double>, ids {one}")
    return mine.groupBy(*VECTOR).agg(F.first("rx").alias("rx"),
                                     F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


class Tree:
    """Median splits of a sample on its widest columns: ``leaf`` numbers the parts, near ones side by side."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.column, self.cut, self.below, self.above, self.leaves = [], [], [], [], 0
        self._grow(sample, leaves)

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        node = len(self.column)
        for v in (self.column, self.cut, self.below, self.above):
            v.append(-1)
        wide = int(np.nan_to_num(x.var(axis=0)).argmax()) if len(x) > 1 and x.shape[1] else -1
        values = np.sort(x[:, wide]) if wide >= 0 else np.empty(0)
        if leaves < 2 or wide < 0 or not values[0] < values[-1]:
            self.below[node] = self.leaves      # a leaf: its number
            self.leaves += 1
            return node
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            cut = values[values < cut].max()
        left = x[:, wide] <= cut
        share = min(max(round(leaves * left.mean()), 1), leaves - 1)
        self.column[node], self.cut[node] = wide, float(cut)
        self.below[node] = self._grow(x[left], share)
        self.above[node] = self._grow(x[~left], leaves - share)
        return node

    def leaf(self, x: np.ndarray) -> np.ndarray:
        column, cut, below, above = map(np.array, (self.column, self.cut, self.below, self.above))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[column[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(x[rows, column[here]] <= cut[here], below[here], above[here])
        return below[at]


def _with_leaves(df: DataFrame, x: str, tree: Tree, per_cell: int) -> DataFrame:
    """``df`` with the leaf that each vector lies in and its cell (``per_cell`` leaves)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.leaf(_matrix(pa.Table.from_batches([b]), x)) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(leaf, pa.int32()), pa.array(leaf // per_cell, pa.int32())],
                [*b.schema.names, "leaf", "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, leaf int, cell int")


def _dealt(queries: DataFrame, others: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work(queries, others)`` for every key.  A key with many queries is dealt to parts of about QUERY_ROWS, each
    with a copy of the key's others, so that no task holds more."""
    parts = queries.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("_parts"))
    mine = queries.join(parts, keys).withColumn("_part", _block(F.col("_parts"), "qkey")).drop("_parts")
    theirs = others.join(parts, keys).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    keys = [*keys, "_part"]
    # a number of its own: the rows are few bytes for the work on them, so it must not follow from their size
    spark = queries.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    deal = lambda df: df.repartition(tasks, *keys).groupBy(*keys)
    return deal(mine).cogroup(deal(theirs.drop("_parts"))).applyInArrow(work, schema)


def _visits(queries: DataFrame, boxes: DataFrame, k: int) -> DataFrame:
    """For every query vector the cells that may hold one of its k nearest rows: (qkey, qx, g, home, cell, reach).
    ``reach``: k rows are surely within this squared distance."""
    def run(q: pa.Table, box: pa.Table) -> pa.Table:
        box = box.sort_by("leaf")
        x, low, high = _matrix(q, "qx"), _matrix(box, "low"), _matrix(box, "high")
        n, cell, home = box.column("n").to_numpy(), box.column("cell").to_numpy(), q.column("leaf").to_numpy()
        reach = q.column("reach").fill_null(np.inf).to_numpy().copy()
        order = np.argsort(home, kind="stable")     # queries of one leaf are near each other
        rows, cells = [], []
        for lo in range(0, len(x), 256):
            at = order[lo:lo + 256]
            part = x[at]
            for i in np.flatnonzero(~np.isfinite(reach[at])):       # no k rows met yet: those of the whole boxes
                far = (np.maximum(part[i] - low, high - part[i]) ** 2).sum(axis=1)
                by_far = np.argsort(far)
                enough = np.searchsorted(np.cumsum(n[by_far]), k)
                reach[at[i]] = far[by_far[enough]] if enough < len(far) else np.inf
            limit = reach[at] * (1 + SLACK)
            gap = np.maximum(0, np.maximum(low - part.max(axis=0), part.min(axis=0) - high))
            some = np.flatnonzero((gap * gap).sum(axis=1) * (1 - SLACK) <= limit.max())
            if not len(some):
                continue
            near = _box_distance(part, low[some], high[some]) * (1 - SLACK) <= limit[:, None]
            first = np.flatnonzero(np.concatenate(([True], cell[some][1:] != cell[some][:-1])))
            i, c = np.nonzero(np.logical_or.reduceat(near, first, axis=1))
            rows.append(at[i])
            cells.append(cell[some][first][c])
        at = np.concatenate(rows) if rows else np.empty(0, np.int64)
        t = q.select(["qkey", "g", "qx", "home"]).take(pa.array(at))
        return t.append_column("reach", pa.array(reach[at])).append_column(
            "cell", pa.array(np.concatenate(cells) if cells else np.empty(0), pa.int32()))

    return _dealt(queries, boxes, ["g"], run, "qkey long, g string, qx array<double>, home int, reach double, cell int")


def _compare(queries: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """(qkey, near): the k nearest of every visited block."""
    return _dealt(queries, refs, ["g", "cell", "block"], lambda q, ref: _nearest(q, ref, k), f"qkey long, near {NEAR}")


def _block(n: Column, key: str) -> Column:
    return F.pmod(F.xxhash64(key), n.cast("long")).cast("int")


def _boxes(refs: DataFrame) -> DataFrame:
    """(g, leaf, cell, n, low, high): the box around the vectors of each leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:       # the boxes of a batch first, then those of its leaves' other batches
            t = pa.Table.from_batches([b]).sort_by([("g", "ascending"), ("leaf", "ascending")])
            if not t.num_rows:
                continue
            x, leaf, g = _matrix(t, "rx"), t.column("leaf").to_numpy(), t.column("g").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], (leaf[1:] != leaf[:-1]) | (g[1:] != g[:-1]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[first], pa.string()), pa.array(leaf[first], pa.int32()),
                 pa.array(t.column("cell").to_numpy()[first], pa.int32()),
                 pa.array(np.diff(np.append(first, len(leaf))), pa.int64()),
                 *[pa.array(list(f.reduceat(x, first)), pa.list_(pa.float64())) for f in (np.fmin, np.fmax)]],
                ["g", "leaf", "cell", "n", "low", "high"])

    def merged(t: pa.Table) -> pa.Table:
        vectors = pa.list_(pa.float64())
        return pa.table({"g": t.column("g").slice(0, 1), "leaf": t.column("leaf").slice(0, 1),
                         "cell": t.column("cell").slice(0, 1), "n": pa.array([int(t.column("n").to_numpy().sum())]),
                         "low": pa.array([np.fmin.reduce(_matrix(t, "low"))], vectors),
                         "high": pa.array([np.fmax.reduce(_matrix(t, "high"))], vectors)})

    fields = "g string, leaf int, cell int, n long, low array<double>, high array<double>"
    return refs.select("g", "rx", "leaf", "cell").mapInArrow(run, fields).groupBy("g", "leaf").applyInArrow(merged, fields)


def knn(query: DataFrame, ref: DataFrame, k: int, exclude_self: bool = True,
        group_col: str | None = None) -> DataFrame:
    """(row_id, nbr_ids array<long>, nbr_labels array<int>) of the k nearest
    reference rows (Euclidean), exact, ties broken by the smaller id; with
    ``group_col`` only reference rows of the query's own group count.

    Equal vectors are searched for once.  Median splits of a bounded sample deal the
    reference vectors to at most PIVOTS leaves, and leaves side by side to cells of
    about BLOCK_ROWS vectors.  A query first meets its own cell, which bounds the
    distance of its k-th neighbour; then it is copied only to the cells with a leaf whose
    box is not beyond that.  A cell with more vectors is kept in blocks, one with many
    queries in parts, so a task never holds more than QUERY_ROWS by BLOCK_ROWS.  Nothing
    is approximate: data without any structure only makes the second step visit more cells."""
    g = F.col(group_col).cast("string") if group_col else F.lit("")
    kk = k + 1 if exclude_self else k       # a row may find itself
    # columns get new names: query and reference are often the same DataFrame
    asked = query.select(F.col(K.ROW_ID).alias("qid"), F.col("x").alias("qx"), F.coalesce(g, F.lit("")).alias("g"))
    given = ref.select(F.coalesce(g, F.lit("")).alias("g"), F.col("x").alias("rx"), F.col(K.ROW_ID).alias("id"),
                       F.col(K.TARGET).cast("int").alias("label"))
    refs = written(distinct_vectors(given, kk), "vectors")
    most = refs.groupBy("g").count().agg(F.max("count")).first()[0]
    none = F.array().cast(NEAR)
    if not most:
        return query.select(K.ROW_ID, F.array().cast("array<long>").alias("nbr_ids"),
                            F.array().cast("array<int>").alias("nbr_labels"))
    width = max(refs.select(F.size("rx")).first()[0], 1)
    sample = [r["rx"] for r in refs.orderBy(F.xxhash64("rx"), "g").limit(max(2, min(SAMPLE, SAMPLE_VALUES // width)))
              .select("rx").collect()]
    tree = Tree(np.array(sample, float), max(1, min(PIVOTS, math.ceil(most / LEAF_ROWS))))
    per_cell = max(1, round(BLOCK_ROWS / max(LEAF_ROWS, most / tree.leaves)))
    leaves = written(_with_leaves(refs, "rx", tree, per_cell), "leaves")
    boxes = written(_boxes(leaves), "boxes")
    cells = boxes.groupBy("g", "cell").agg(F.ceil(F.sum("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    refs = leaves.join(cells, ["g", "cell"]).select("g", "cell", _block(F.col("blocks"), "rx").alias("block"), "leaf", "rx",
                                                  "ids")
    if query is ref:        # the same vectors, dealt to leaves already
        vectors = leaves.select(*VECTOR, F.col("rx").alias("qx"), "leaf", "cell")
    else:
        each = _keyed(asked, "qx", ["g", "qx"]).groupBy(*VECTOR).agg(F.first("qx").alias("qx"))
        vectors = _with_leaves(each, "qx", tree, per_cell)
    vectors = written(vectors.withColumn("qkey", F.monotonically_increasing_id()), "queries")
    at_home = vectors.join(cells, ["g", "cell"]).withColumn("block", _block(F.col("blocks"), "qx"))
    at_home = at_home.select("qkey", "g", "qx", "cell", "block", F.lit(None).cast("double").alias("reach"))
    first = written(_compare(at_home, refs, kk), "near")
    met = first.select("qkey", F.when(F.size("near") >= kk, F.element_at("near", kk)["d"]).alias("reach"))
    reached = vectors.join(met, "qkey", "left")
    reached = reached.select("qkey", "g", "qx", "leaf", F.col("cell").alias("home"), "reach")
    visits = written(_visits(reached, boxes, kk), "visits")
    rest = visits.join(cells, ["g", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.filter((F.col("home") != F.col("cell")) | (F.col("block") != _block(F.col("blocks"), "qx")))
    found = first.unionByName(_compare(rest.select("qkey", "g", "qx", "cell", "block", "reach"), refs, kk))
    best = found.groupBy("qkey").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, kk).alias("near"))
    best = written(vectors.select("qkey", *VECTOR).join(best, "qkey").drop("qkey"), "nearest")  # read more than once
    out = _keyed(asked, "qx", ["qid", "g"]).join(best, VECTOR, "left")
    mine = F.filter("near", lambda v: v["id"] != F.col("qid")) if exclude_self else F.col("near")
    out = out.select(F.col("qid").alias(K.ROW_ID), F.coalesce(F.slice(mine, 1, k), none).alias("near"))
    return out.select(K.ROW_ID, F.col("near.id").alias("nbr_ids"), F.col("near.label").alias("nbr_labels"))


def _minority(df: DataFrame) -> tuple[int, int, int, int]:
    counts = {r[K.TARGET]: r["n"] for r in df.groupBy(K.TARGET).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError(f"resampling needs exactly 2 classes; there are {len(counts)}")
    (mi, n_min), (ma, n_maj) = sorted(counts.items(), key=lambda kv: (kv[1], kv[0]))
    return mi, n_min, ma, n_maj


def _synthesize(bases: DataFrame, ref: DataFrame, n_new: int, k: int, step: float, seed: int, tag: str,
                minority_label: int, id_offset: int = 0) -> DataFrame:
    """``bases``: (row_id, x, nbr_ids); draws n_new synthetic rows."""
    if n_new <= 0:
        return None
    spark = bases.sparkSession
    bases = bases.filter(F.size("nbr_ids") > 0)  # a base needs at least one neighbour
    bases = written(bases.select(K.ROW_ID, "x", "nbr_ids", F.monotonically_increasing_id().alias("_base")), "bases")
    # only the ids are sorted for the numbers, not the vectors
    pos = materialize(row_numbers(bases.select(K.ROW_ID, "_base"), K.ROW_ID, tie_cols=["_base"], name="_pos"))
    n_b = pos.count()
    if n_b == 0:
        return None
    s = spark.range(n_new).select(F.col("id").alias("s"))
    key = lambda t: F.concat(F.lit(f"{seed}_{tag}_{t}_"), F.col("s").cast("string"))
    s = s.select("s", (md5_bucket(key("b"), n_b) + 1).alias("_pos"), md5_bucket(key("n"), k).alias("_j"),
                 (md5_bucket(key("u"), U_MOD) / float(U_MOD)).alias("_u"))
    j = s.join(pos.select("_pos", "_base"), "_pos").join(bases.select("_base", "x", "nbr_ids"), "_base")
    j = j.select("s", "x", "_u", F.element_at("nbr_ids", (F.col("_j") % F.size("nbr_ids") + 1).cast("int"))
                 .alias("_nbr"))
    r = ref.select(F.col(K.ROW_ID).alias("_nbr"), F.col("x").alias("_xn"))
    j = j.join(r, "_nbr")
    xnew = F.zip_with("x", "_xn", lambda a, b: a + F.lit(step) * F.col("_u") * (b - a))
    out = j.select((-(F.col("s") + 1 + id_offset)).cast("long").alias(K.ROW_ID),
                   F.lit(minority_label).cast("int").alias(K.TARGET), xnew.alias("x"))
    return out


def _assemble(arr: DataFrame, synth: list[DataFrame], features: str) -> DataFrame:
    out = arr.withColumn("synthetic", F.lit(0))
    for s in synth:
        if s is not None:
            out = out.unionByName(s.withColumn("synthetic", F.lit(1)))
    return out.select(K.ROW_ID, K.TARGET, array_to_vector("x").alias(features), "synthetic")


def smote(df: DataFrame, k: int = 5, ratio: float = 1.0, seed: int = 8, features: str = "features") -> DataFrame:
    """Add floor(ratio * n_majority) - n_minority synthetic minority rows, each
    on the segment from a minority row to one of its k minority neighbours."""
    # read many times below, as arrays: a vector would be unpacked each time, for each column that is made of it
    arr = written(_as_array(df, features), "encoded")
    mi, n_min, _, n_maj = _minority(arr)
    n_new = int(ratio * n_maj - n_min)
    mino = arr.filter(F.col(K.TARGET) == mi)
    nb = knn(mino, mino, k)
    bases = mino.join(nb, K.ROW_ID)
    syn = _synthesize(bases, mino, n_new, k, 1.0, seed, "smote", mi)
    return _assemble(arr, [syn], features)


def svm_smote(df: DataFrame, k: int = 5, m: int = 10, ratio: float = 1.0, out_step: float = 0.5, seed: int = 8,
              features: str = "features", reg: float = 0.01) -> DataFrame:
    """SVM-SMOTE: minority rows inside the linear SVM margin are the bases;
    those whose m nearest rows (all classes) are all majority are noise and
    dropped; 'danger' bases (half or more majority) interpolate, 'safe'
    bases extrapolate by out_step; the split of the new rows between the
    two draws a seeded Beta(10, 10) fraction."""
    arr_all = written(_as_array(df, features), "encoded")     # read many times below
    df = arr_all.select("*", array_to_vector("x").alias(features))
    mi, n_min, _, n_maj = _minority(arr_all)
    n_new = int(ratio * n_maj - n_min)
    width = df.select(features).first()[features].size
    svm = LinearSVC(featuresCol=features, labelCol=K.TARGET, regParam=reg, maxIter=100, standardization=False,
                    rawPredictionCol="_raw", predictionCol="_pred").fit(
        gathered(df.select(features, K.TARGET), n_min + n_maj, width))
    sc = svm.transform(df.filter(F.col(K.TARGET) == mi))
    sup = sc.filter(F.abs(vector_to_array("_raw")[1]) <= 1.0).select(K.ROW_ID, K.TARGET, "x")
    mino = arr_all.filter(F.col(K.TARGET) == mi)
    nb_all = knn(sup, arr_all, m)
    n_maj_nb = F.aggregate("nbr_labels", F.lit(0), lambda acc, y: acc + F.when(y != mi, 1).otherwise(0))
    kind = nb_all.select(K.ROW_ID, n_maj_nb.alias("_nm")).select(
        K.ROW_ID, F.when(F.col("_nm") == m, "noise").when(F.col("_nm") >= m / 2.0, "danger").otherwise("safe")
        .alias("_kind"))
    nb_min = knn(sup.join(kind.filter("_kind != 'noise'"), K.ROW_ID), mino, k)
    bases = sup.join(kind, K.ROW_ID).join(nb_min, K.ROW_ID)
    frac = float(np.random.default_rng(seed).beta(10, 10))
    n_danger = int(frac * (n_new + 1)) if n_new > 0 else 0
    danger = _synthesize(bases.filter("_kind = 'danger'"), mino, n_danger, k, 1.0, seed, "svm_d", mi)
    safe = _synthesize(bases.filter("_kind = 'safe'"), mino, max(n_new - n_danger, 0), k, -out_step, seed,
                       "svm_s", mi, id_offset=n_danger)
    return _assemble(arr_all, [danger, safe], features)
