"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

A document is the set of hashes of its runs of five words (lower-cased, split
at ASCII white space; a shorter text is one run).  Documents with equal sets are
one class and are compared once.  The signature of a class has TREES rows of DEPTH
MinHash values: one path in each of TREES prefix tries.

Classes that share a prefix of ``depth`` values in some tree are candidates.
The search starts at full depth and shortens the prefixes by one value as long as
the estimated recall is below the target.  The estimate is measured: each
verified pair of similarity s stands for 1 / P(s) pairs, where
P(s) = 1 - (1 - s ** depth) ** TREES is its chance of being found.

No pair is ever written out.  The members of a bucket are dealt into blocks
of BLOCK classes; a unit is two blocks (or one), and the unit's task
compares its pairs by matrix products.  A pair belongs to the first tree in which
it shares a prefix, so it is counted once.  A unit returns for each class
how many links it has and the root of its part of a spanning forest.  Connected
components are found by large-star and small-star steps over those edges.

Defined results: null texts and texts without a word have no class and stay alone
with no links; repeated rows are copies of each other; ties cannot occur
(similarity is compared as whole numbers); an empty table gives an empty
result; other columns stay out of ``links`` and are kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import Words, mix64, passes, shingles, small_batches, text_hash
from credspark.session import materialize

WORDS_IN_SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH = 20, 6
TARGET_RECALL = 0.999
BLOCK = 256
#: Keys of candidate classes up to this size are broadcast to pick their texts; else the texts are shuffled.
BROADCAST_BYTES = 48 << 20

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def shingle_sets(texts: list[str | None], n: int = WORDS_IN_SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, part in passes(texts):
        w = Words([(t or "").lower() for t in part])
        for i in range(len(part)):
            yield shingles(w.hash[w.borders[i]: w.borders[i + 1]], n)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, TREES * DEPTH) MinHash values of 32 bits; no set may be empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    for k in range(TREES * DEPTH):
        h = flat ^ _B[k]
        h *= _A[k]
        out[:, k] = np.minimum.reduceat(h, starts) >> np.uint64(32)
    return out


def prefix_keys(signatures: np.ndarray, depth: int) -> np.ndarray:
    """(n, TREES) keys of the prefixes of ``depth`` values; keys of two trees differ."""
    rows = signatures.reshape(len(signatures), TREES, DEPTH).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(depth):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key


def found_share(s: np.ndarray | float, depth: int) -> np.ndarray | float:
    """The chance that a pair of similarity ``s`` shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - s ** depth) ** TREES


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def signed(docs: DataFrame) -> DataFrame:
    """d (id, th), cls (16 bytes; null without words), sig (bytes of the signature) for every row."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, sig, held, at, size = [None] * b.num_rows, [None] * b.num_rows, [], [], 0

            def flush() -> None:
                if held:
                    for i, s in zip(at, minhashes(held)):
                        sig[i] = s.tobytes()
                    held.clear()
                    at.clear()

            for i, s in enumerate(shingle_sets(b.column(1).to_pylist())):
                if len(s):
                    cls[i] = xxhash.xxh3_128_digest(s.tobytes())
                    held.append(s)
                    at.append(i)
                    size += len(s)
                    if size > 200_000:
                        flush()
                        size = 0
            flush()
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(cls), _binary(sig)], ["d", "cls", "sig"])

    d = F.struct(F.col("doc_id").alias("id"), text_hash().alias("th"))
    return docs.select(d.alias("d"), "text").mapInArrow(run, f"d struct<id:{id_type},th:bigint>, cls binary, sig binary")


def _keyed(classes: DataFrame, depth: int) -> DataFrame:
    """cls, members, keys at ``depth``, and ``deeper``: keys one value deeper, or none at full depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(b.num_rows, -1)
            keys = prefix_keys(sig, depth).view(np.int64)
            deep = prefix_keys(sig, depth + 1).view(np.int64) if depth < DEPTH else keys[:, :0]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(list(x), pa.list_(pa.int64())) for x in (keys, deep)]],
                ["cls", "members", "keys", "deeper"])

    return classes.select("cls", "members", "sig").mapInArrow(
        run, "cls binary, members bigint, keys array<bigint>, deeper array<bigint>")


def by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of batches sorted by (key, lo, hi), unit by unit."""
    unit, rows = None, {}
    for b in batches:
        cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        names = list(zip(cols["key"], cols["lo"], cols["hi"]))
        start = 0
        for i in range(len(names) + 1):
            if i == len(names) or names[i] != (names[i - 1] if i else unit):
                if i > start:
                    for n, v in cols.items():
                        rows.setdefault(n, []).extend(v[start:i])
                if i < len(names):
                    if rows:
                        yield unit, rows
                    unit, rows, start = names[i], {}, i
    if rows:
        yield unit, rows


def own_pairs(key: int, lo: int, hi: int, rows: dict[str, list]) -> np.ndarray:
    """(n, n) above the diagonal: the pairs of this unit that no earlier tree and no deeper search has compared."""
    keys = np.array(rows["keys"], np.int64)
    n = len(keys)
    tree = int(np.flatnonzero(keys[0] == key)[0])
    own = np.triu(np.ones((n, n), bool), 1)
    if lo != hi:
        block = np.array(rows["block"])
        own &= block[:, None] != block[None, :]
    for t in range(tree):
        own &= keys[:, None, t] != keys[None, :, t]
    deeper = np.array(rows["deeper"], np.int64)
    for t in range(deeper.shape[1] if deeper.ndim == 2 else 0):
        own &= deeper[:, None, t] != deeper[None, :, t]
    return own


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """(n, n) numbers of common members, by products of 0/1 matrices over slices of the members."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = often[at] > 1
    at, owner = at[shared], owner[shared]
    _, at = np.unique(at, return_inverse=True)
    out = np.zeros((n, n), np.float64)
    width = 4096
    for start in range(0, int(at.max()) + 1 if len(at) else 0, width):
        here = (at >= start) & (at < start + width)
        m = np.zeros((n, width), np.float32)
        m[owner[here], at[here] - start] = 1
        out += m @ m.T
    return out.astype(np.int64)


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric relation, the smallest index of its component."""
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        if (new == root).all():
            return root
        root = new


def _compare(keyed: DataFrame, classes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """cls, root, links, doc_links, and weights w1.. by depth, of every class with links in a unit."""
    spark = docs.sparkSession
    tree_rows = keyed.select("cls", F.explode("keys").alias("key"))
    buckets = tree_rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    units = (tree_rows.join(buckets, "key").join(keyed, "cls")
             .withColumn("blocks", n_blocks)
             .withColumn("block", F.pmod(F.xxhash64("cls", "key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "block", "cls", "members", "keys", "deeper"))
    schema = ("key bigint, lo int, hi int, block int, cls binary, members bigint, "
              "keys array<bigint>, deeper array<bigint>")

    def with_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only the classes that have a pair of their own in the unit."""
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            b = pa.RecordBatch.from_arrays([pa.array(held[n], k) for n, k in zip(held, kinds)], list(held))
            held.clear()
            return b

        for unit, rows in by_unit(batches):
            own = own_pairs(*unit, rows)
            for i in np.flatnonzero((own | own.T).any(axis=1)):
                for n, v in rows.items():
                    held.setdefault(n, []).append(v[i])
            if held and len(held["key"]) >= 1000:
                yield out()
        if held:
            yield out()

    sorted_units = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    wanted = materialize(sorted_units.mapInArrow(with_own, schema))

    need = materialize(wanted.select("cls").distinct().join(classes.select("cls", "d"), "cls"))
    texts = docs.select(F.struct(F.col("doc_id").alias("id"), text_hash().alias("th")).alias("d"), "text")
    chosen = F.broadcast(need) if need.count() * 64 <= BROADCAST_BYTES else need
    texts = texts.alias("t").join(chosen.alias("n"), (F.col("t.d.id").eqNullSafe(F.col("n.d.id")))
                                  & (F.col("t.d.th") == F.col("n.d.th")))
    texts = texts.select("cls", "text")
    ready = (wanted.join(texts, "cls").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))
    num = round(similarity * 1000)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
            b = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                                           ["cls", "root", "links", "doc_links", "weights"])
            out.clear()
            return b

        for unit, rows in by_unit(batches):
            first = {c: i for i, c in reversed(list(enumerate(rows["cls"])))}    # repeated rows of a text
            pick = sorted(first.values())
            rows = {n: [v[i] for i in pick] for n, v in rows.items()}
            sets = list(shingle_sets(rows["text"]))
            common = common_counts(sets)
            sizes = np.array([len(s) for s in sets])
            union = sizes[:, None] + sizes[None, :] - common
            linked = own_pairs(*unit, rows) & (common * 1000 >= num * union)
            if not linked.any():
                continue
            a, b = np.nonzero(linked)
            s = common[a, b] / union[a, b]
            linked = linked | linked.T
            members = np.array(rows["members"], np.int64)
            weights = np.zeros((len(sets), DEPTH))
            for d in range(1, DEPTH + 1):
                w = 1 / found_share(s, d)
                weights[:, d - 1] = (np.bincount(a, w, len(sets)) + np.bincount(b, w, len(sets)))
            order = sorted(range(len(sets)), key=rows["cls"].__getitem__)
            roots = _roots(linked[np.ix_(order, order)])
            root_of = {order[i]: order[r] for i, r in enumerate(roots)}
            for i in np.flatnonzero(linked.any(axis=1)):
                out.append((rows["cls"][i], rows["cls"][root_of[i]], int(linked[i].sum()),
                            int(members[linked[i]].sum()), list(weights[i])))
            if len(out) >= 2000:
                yield flush()
        if out:
            yield flush()

    return materialize(ready.select("key", "lo", "hi", "block", "cls", "members", "keys", "deeper", "text").mapInArrow(
        verify, "cls binary, root binary, links bigint, doc_links bigint, weights array<double>"))


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``edges`` (u, v) but the roots: root is the smallest vertex of the component.

    Alternating large-star and small-star steps; each leaves a written table, so lineage stays short.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct())
    size = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())
    before = size(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        #: Written first: a join of two shuffles is one that Spark can split where a root has very many edges.
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = materialize(small)
        after = size(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("v"), F.col("v").alias("root"))


def _linked(docs: DataFrame, similarity: float, target: float) -> tuple[DataFrame, DataFrame]:
    """Rows (d, cls) of all documents; classes with members, first d, root class, links and doc_links."""
    rows = materialize(signed(docs))
    classes = materialize(rows.filter("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("members"), F.min("d").alias("d"), F.min("d.id").alias("low"),
        F.first("sig").alias("sig")))
    found = None
    for depth in range(DEPTH, 0, -1):
        keyed = materialize(_keyed(classes, depth))
        new = _compare(keyed, classes, docs, similarity)
        found = new if found is None else found.unionByName(new)
        sums = found.agg(F.sum("links").alias("n"), F.sum(F.col("weights")[depth - 1]).alias("w")).first()
        if not sums["n"] or sums["n"] / sums["w"] >= target:
            break
    roots = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    degrees = found.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("doc_links").alias("doc_links"))
    classes = (classes.drop("sig").join(roots.withColumnRenamed("v", "cls"), "cls", "left")
               .join(degrees, "cls", "left")
               .select("cls", "members", "d", "low", F.coalesce("root", "cls").alias("root"),
                       F.coalesce("links", F.lit(0)).alias("links"),
                       F.coalesce("doc_links", F.lit(0)).alias("doc_links")))
    return rows.select("d", "cls"), materialize(classes)


def _first_of_root(classes: DataFrame) -> DataFrame:
    first = classes.groupBy("root").agg(F.min("d").alias("first"), F.min("low").alias("low_id"),
                                         F.sum("members").alias("group_size"))
    return classes.join(materialize(first), "root")


def links(docs: DataFrame, similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> DataFrame:
    """For every row: doc_id, class_id, n_links, n_text_links, group_size.

    class_id is the smallest doc_id that is not null in the row's group (documents connected by links).  n_links
    counts the other documents of at least that similarity; n_text_links counts each set of
    shingles once and leaves out copies.
    """
    rows, classes = _linked(docs, similarity, target)
    known = _first_of_root(classes).select("cls", "low_id", "members", "links", "doc_links", "group_size")
    return rows.join(known, "cls", "left").select(
        F.col("d.id").alias("doc_id"), F.coalesce("low_id", "d.id").alias("class_id"),
        F.coalesce(F.col("members") - 1 + F.col("doc_links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_text_links"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> DataFrame:
    """``docs`` with the first document (by doc_id, then text hash) of each group; rows without words all stay."""
    rows, classes = _linked(docs, similarity, target)
    known = _first_of_root(classes).select("cls", "first")
    gone = (rows.join(known, "cls").filter("d <> first")
            .select(F.col("d.id").alias("k_id"), F.col("d.th").alias("k_th")).distinct())
    tagged = docs.withColumn("_llm_th", text_hash())
    cond = tagged["doc_id"].eqNullSafe(gone["k_id"]) & (tagged["_llm_th"] == gone["k_th"])
    out = tagged.join(gone, cond, "left_anti")
    twice = rows.filter("cls is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():     # the same id and text in several rows
        again = F.struct(F.col("doc_id").alias("id"), F.col("_llm_th").alias("th"))
        tell = out.withColumn("_llm_d", again).join(twice.select(F.col("d").alias("_llm_t")),
                                                    F.col("_llm_d").eqNullSafe(F.col("_llm_t")), "left")
        one = tell.filter("_llm_t is null")
        many = tell.filter("_llm_t is not null").dropDuplicates(["doc_id", "_llm_th"])
        out = one.unionByName(many)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
