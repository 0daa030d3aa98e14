"""Line dedup by pairwise alignment.

Two documents overlap where they share a run of lines that holds at least
``min_words`` words.  For every line, the shortest run from it that holds that
many words is hashed.  Such a run is far rarer than a line, and every common
block with enough words begins with one, so joining documents on run hashes
finds all overlaps.  All documents with a run are paired with the earliest one
only: a run in n documents gives n - 1 pairs, however common it is.

Documents that share rare lines between edits have no such run.  A line is rare if
at most RARE_DOCS documents of different lines hold it; all of these are paired
with each other, and a pair whose rare lines hold ``min_words`` words together
is aligned too.  Exact copies stand as one document here: runs find them.

Each pair is aligned with patience diff on line hashes; common blocks of at
least ``min_words`` words are deleted from the later document.  Blocks that
stand in another order in both documents remain after a first alignment, so what
is left is aligned again, ROUNDS times at most; every run that both documents still
share (out of order, or without a line unique on both sides) is then
deleted by its run hash, so no repeated run survives in the later document.
Shorter blocks are decided together: where the rare lines in all aligned blocks
of a pair hold ``min_words`` words, every aligned block with a rare line is deleted.
Rare lines that ROUNDS alignments do not match (in wholly another order) and
lines held by more documents stay, unless they are in a repeated run.

"Earlier" is the order (doc_id, text hash), null ids first.  Documents travel as
arrays of line hashes; texts are joined once, when lines are deleted.

Defined results: lines without a word never count and are deleted only inside
a deleted block; null texts stay null; empty tables give empty results; a
document that is deleted whole has an empty text; repeated rows with the same
id and text count as one document, so none of them is deleted for another;
columns of the input, also clashing ones, are kept as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import small_batches, text_hash
from credspark.session import materialize

MIN_WORDS = 30
#: A line in more documents is common: it neither makes pairs nor counts as evidence.
RARE_DOCS = 20
ROUNDS = 3


def line_arrays(text: str) -> tuple[list[int], list[int], list[int]]:
    """Hash (signed 64 bit), words and position of every line that has a word."""
    hashes, words, at = [], [], []
    for i, line in enumerate(text.split("\n")):
        parts = line.split()
        if parts:
            h = xxhash.xxh64_intdigest(" ".join(parts).encode("utf-8", "replace"))
            hashes.append(h - (1 << 63))
            words.append(len(parts))
            at.append(i)
    return hashes, words, at


def runs(hashes: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(run hash, first line) of the shortest run with ``min_words`` words from each line that has one."""
    out, end, have = [], 0, 0
    for i in range(len(hashes)):
        while end < len(hashes) and have < min_words:
            have += words[end]
            end += 1
        if have < min_words:
            break
        key = ",".join(map(str, hashes[i:end]))
        out.append((xxhash.xxh64_intdigest(key) - (1 << 63), i))
        have -= words[i]
    return out


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matching positions of ``a`` and ``b`` by patience diff, increasing on both sides."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        ca, cb = Counter(a[i:m]), Counter(b[j:n])
        where = {b[k]: k for k in range(j, n) if cb[b[k]] == 1}
        pairs = [(k, where[a[k]]) for k in range(i, m) if ca[a[k]] == 1 and a[k] in where]
        anchors = increasing(pairs)
        if not anchors:
            continue
        p, q = i, j
        for x, y in [*anchors, (m, n)]:
            todo.append((p, x, q, y))
            p, q = x, y
        # every segment but the first starts with its anchor, which the prefix step matches
    return sorted(out)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``pairs`` (first members increase) whose second members increase."""
    tops: list[int] = []
    last: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        back[k] = last[at - 1] if at else -1
        if at == len(tops):
            tops.append(y)
            last.append(k)
        else:
            tops[at], last[at] = y, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _aligned(early: list[int], late: list[int], chosen: Callable[[list[int]], bool]) -> set[int]:
    """Lines of ``late`` in the blocks ``chosen`` of up to ROUNDS alignments, each of what the one before left."""
    gone: set[int] = set()
    rest: list = list(late)
    for _ in range(ROUNDS):
        blocks, before = [], (-2, -2)
        for i, j in patience(rest, early):
            if (i - 1, j - 1) == before:
                blocks[-1].append(i)
            else:
                blocks.append([i])
            before = (i, j)
        new = [i for b in blocks if chosen(b) for i in b]
        if not new:
            break
        gone.update(new)
        for i in new:
            rest[i] = None      # equal to no line
    return gone


def common_blocks(early: list[int], late: list[int], words: list[int], min_words: int,
                  rare: frozenset[int] = frozenset()) -> list[int]:
    """Lines of ``late`` in blocks that stand in ``early`` too: those of at least ``min_words`` words, and all
    with a line of ``rare`` where such lines hold as many words together."""
    gone = _aligned(early, late, lambda b: sum(words[i] for i in b) >= min_words)
    theirs = {h for h, _ in runs(early, _words_as(early, late, words), min_words)}
    for h, i in runs(late, words, min_words):
        if h in theirs:
            have = 0
            while have < min_words:
                have += words[i]
                gone.add(i)
                i += 1
    if not rare.isdisjoint(late):
        shared = _aligned(early, late, lambda b: any(late[i] in rare for i in b))
        if sum({late[i]: words[i] for i in shared if late[i] in rare}.values()) >= min_words:
            gone |= shared
    return sorted(gone)


def _words_as(early: list[int], late: list[int], words: list[int]) -> list[int]:
    """Words of the lines of ``early`` that stand in ``late``; a line that doesn't ends every run there."""
    known = dict(zip(late, words))
    return [known.get(h, 1 << 30) for h in early]


def _ids(docs: DataFrame) -> Column:
    return F.struct(F.col("doc_id").alias("id"), text_hash().alias("th"))


def _same() -> Column:
    """One value for all documents of the same lines."""
    return F.xxhash64("lines").alias("same")


def _rare_lines(lined: DataFrame) -> DataFrame:
    """line, same, words of the lines that 2 to RARE_DOCS documents of different lines hold."""
    held = (lined.select(_same(), F.explode(F.array_distinct(F.arrays_zip("lines", "words"))).alias("z"))
            .select(F.col("z.lines").alias("line"), "same", F.col("z.words").alias("words")).distinct())
    few = held.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(2, RARE_DOCS))
    return materialize(held.join(few.select("line"), "line"))


def _rare_pairs(lined: DataFrame, rare: DataFrame, min_words: int) -> DataFrame:
    """d, early and their common rare lines, of the pairs in which these hold at least ``min_words`` words."""
    other = rare.select("line", F.col("same").alias("other"))
    pairs = (rare.join(other, "line").filter("same < other").groupBy("same", "other")
             .agg(F.sum("words").alias("n"), F.collect_list("line").alias("rare")).filter(F.col("n") >= min_words))
    first = lined.groupBy(_same()).agg(F.min("d").alias("d"))
    return (pairs.join(first, "same").join(first.select(F.col("same").alias("other"), F.col("d").alias("e")), "other")
            .select(F.greatest("d", "e").alias("d"), F.least("d", "e").alias("early"), "rare"))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """d (id, th) of every document that loses lines, and ``gone``: their positions, from 0."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [line_arrays(t or "") for t in b.column(1).to_pylist()]
            keys = [[h for h, _ in runs(g[0], g[1], min_words)] for g in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.list_(k)) for c, k in
                                (([g[0] for g in got], pa.int64()), ([g[1] for g in got], pa.int32()),
                                 ([g[2] for g in got], pa.int32()), (keys, pa.int64()))]],
                ["d", "lines", "words", "at", "runs"])

    d_type = f"struct<id:{id_type},th:bigint>"
    lined = materialize(docs.select(_ids(docs).alias("d"), "text").mapInArrow(
        split, f"d {d_type}, lines array<bigint>, words array<int>, at array<int>, runs array<bigint>"))
    long_enough = lined.select("d", F.explode(F.array_distinct("runs")).alias("run"))
    first = (long_enough.groupBy("run").agg(F.min("d").alias("early"), F.max("d").alias("latest"))
             .filter("early <> latest").select("run", "early"))
    pairs = (long_enough.join(first, "run").filter("d <> early")
             .select("d", "early"))
    # a pair found by runs alone has too few rare lines in common for them to decide anything
    pairs = pairs.unionByName(_rare_pairs(lined, _rare_lines(lined), min_words), allowMissingColumns=True)
    pairs = pairs.groupBy("d", "early").agg(F.max("rare").alias("rare"))
    once = lined.dropDuplicates(["d"])
    late = once.select("d", F.col("lines").alias("b"), "words", "at")
    early = once.select(F.col("d").alias("early"), F.col("lines").alias("a"))
    both = (pairs.join(early, "early").join(late, "d")
            .select("d", "a", "b", "words", "at", "rare"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            a, b, words, at, few = (x.column(k).to_pylist() for k in range(1, 6))
            gone = []
            for i in range(len(a)):
                lost = common_blocks(a[i], b[i], words[i], min_words, frozenset(few[i] or ()))
                # blank lines between two deleted neighbours go with them
                full = set()
                for p, q in zip(lost, [*lost[1:], -1]):
                    full.update(range(at[i][p], at[i][q]) if q == p + 1 else [at[i][p]])
                gone.append(sorted(full))
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(gone, pa.list_(pa.int32()))], ["d", "gone"])

    return (both.mapInArrow(align, f"d {d_type}, gone array<int>").filter(F.size("gone") > 0)
            .groupBy("d").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, gone_as: str | None = None) -> DataFrame:
    """``docs`` with repeated blocks deleted from ``text``; ``gone_as`` names a column for the deleted lines."""
    lost = deletions(docs, min_words).select(F.col("d.id").alias("_llm_id"), F.col("d.th").alias("_llm_th"),
                                             F.col("gone").alias("_llm_gone"))
    tagged = docs.withColumn("_llm_key", text_hash())
    both = tagged.join(lost, tagged["doc_id"].eqNullSafe(lost["_llm_id"])
                       & (tagged["_llm_key"] == lost["_llm_th"]), "left")
    both = both.withColumn("_llm_lines", F.when(F.col("_llm_gone").isNotNull(), F.split("text", "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_llm_lines") - 1), F.col("_llm_gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(F.col("_llm_lines"), i)), "\n")
    out = both.withColumn("text", F.when(F.col("_llm_gone").isNull(), F.col("text")).otherwise(rest))
    keep = [F.col(f"`{c}`") for c in docs.columns]
    if gone_as:
        keep.append(F.coalesce("_llm_gone", F.array().cast("array<int>")).alias(gone_as))
    return out.select(*keep)
