"""Benchmark decontamination by spaced seeds.  DataFrame functions only.

Words are runs of letters and digits, lower-cased.  A document overlaps a
benchmark item where some ``WINDOW`` words in a row equal the item's words at
the same distances, but for a fifth of them at most (13 words: 2 may differ).
A seed hashes the words at the care positions of a fixed mask and ignores
the others.  The two masks together were chosen by trying all masks of
weight 6: each of the 78 ways to place two substitutions in 13 words leaves
at least one seed whole, so the search loses no overlap by the rule above.

Plan: benchmark seeds, each with the words around it, are hashed; documents
are read once, their word positions exploded inside the same stage, and
joined with the seeds by broadcast, so no document text is shuffled.  A
benchmark whose seeds exceed ``BLOCK_BYTES`` is taken block by block, each
block against all documents.  Every hit is verified on the words around it.

Items of fewer than 13 words have seeds of their own, unbroken runs of words: an
item of 8 to 12 words is cut into two halves, one of which any single substitution
leaves whole, and may differ in one word; a shorter item must be there word for
word.  Documents are hashed at the few run lengths that the benchmark's short
items have, and only then.  A letter of a script written without spaces (Han,
kana, Thai, Lao, Khmer, Burmese) is a word of its own.

Defined results: null and empty texts and items overlap nothing; an item of any
length counts, a single word too, so a caller who takes short items for no
evidence filters the benchmark; repeated documents or items give equal rows
once; empty tables give none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import drop_keys, text_hash
from credspark.session import materialize

MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 7, 8))
WINDOW = 13
MIN_SHARE = 0.8
#: A shorter item must be there word for word; from here to WINDOW - 1 words one may differ.
LOOSE_FROM = 8
#: Most bytes of benchmark seeds that are broadcast at once.
BLOCK_BYTES = 64 << 20
_SEED_BYTES = 8 * 2 * WINDOW + 64

SPAN = max(m[-1] for m in MASKS) + 1
REACH = WINDOW - min(m[-1] for m in MASKS) - 1     # words before a seed that a window with it may hold


#: Letters that stand for words: their scripts put no spaces between them.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def word_hashes(text: Column) -> Column:
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _UNSPACED, " $1 ")
    words = F.split(apart, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def needed(item_words: Column, share: float) -> Column:
    """How many words of a window, or of a shorter item, must be equal."""
    return (F.when(item_words >= WINDOW, F.lit(math.ceil(share * WINDOW - 1e-9)))
            .when(item_words >= LOOSE_FROM, item_words - 1).otherwise(item_words))


def _by_mask(values: list[Column]) -> Column:
    out = values[-1]
    for m in range(len(values) - 2, -1, -1):
        out = F.when(F.col("m") == m, values[m]).otherwise(out)
    return out


def _seeds(hashed: DataFrame) -> DataFrame:
    """``hashed`` (.., h: array of word hashes) with one row for each mask and position: m, i, seed, around.

    ``around`` holds the 2 * WINDOW words whose first is REACH words before ``i``, null beyond the text.
    The expressions are kept short: a generated method over 8,000 bytes of code is never compiled by the JVM.
    """
    masks, width = len(MASKS), min(m[-1] for m in MASKS) + 1
    none = F.lit(None).cast("bigint")
    others = [c for c in hashed.columns if c != "h"]
    rows = hashed.select(*others, F.size("h").alias("n"), F.concat(
        F.array_repeat(none, REACH), F.col("h"), F.array_repeat(none, 2 * WINDOW)).alias("hp"))
    #: The outer form keeps Spark from filtering on (and so hashing) the words a second time below the explode.
    rows = rows.withColumn("at", F.explode_outer(
        F.when(F.col("n") >= width, F.sequence(F.lit(0), masks * (F.col("n") - width + 1) - 1))))
    rows = rows.withColumn("i", F.expr(f"cast(at div {masks} as int)")).withColumn("m", F.col("at") % masks)
    seed = _by_mask([F.xxhash64(F.lit(m), *[F.get("hp", F.col("i") + (o + REACH)) for o in mask])
                     for m, mask in enumerate(MASKS)])
    last = _by_mask([F.lit(mask[-1]) for mask in MASKS])
    return rows.filter(F.col("i") + last < F.col("n")).withColumn("seed", seed)


def _around() -> Column:
    return F.slice("hp", F.col("i") + 1, 2 * WINDOW)


def item_seeds(benchmark: DataFrame) -> DataFrame:
    items = (benchmark.select("item_id", word_hashes(F.col("text")).alias("h"))
             .filter(F.size("h") >= WINDOW).dropDuplicates(["item_id", "h"]))
    return _seeds(items).select("item_id", "seed", F.col("n").alias("item_words"), _around().alias("b"))


def short_seeds(benchmark: DataFrame) -> DataFrame:
    """item_id, item_words, w (the item's word hashes), k, from, seed: the runs of words that stand for an item of
    fewer than WINDOW words, k words from word ``from`` on."""
    items = (benchmark.select("item_id", word_hashes(F.col("text")).alias("w")).withColumn("item_words", F.size("w"))
             .filter(F.col("item_words").between(1, WINDOW - 1)).dropDuplicates(["item_id", "w"]))
    n = F.col("item_words")
    half = F.floor(n / 2).cast("int")
    run = lambda k, at: F.struct(k.alias("k"), at.alias("from"))
    runs = F.when(n >= LOOSE_FROM, F.array(run(half, F.lit(0)), run(n - half, half))).otherwise(F.array(run(n, F.lit(0))))
    return items.select("item_id", "item_words", "w", F.explode(runs).alias("r")).select(
        "item_id", "item_words", "w", "r.k", "r.from", F.xxhash64("r.k", F.slice("w", F.col("r.from") + 1, F.col("r.k")))
        .alias("seed"))


def short_overlaps(hashed: DataFrame, seeds: DataFrame, lengths: list[int], blocks: int, share: float) -> DataFrame:
    """Overlaps of documents (doc_id, th, h) with items of fewer than WINDOW words."""
    none = F.array_repeat(F.lit(None).cast("bigint"), WINDOW)
    at = F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(0), len(lengths) * F.col("n") - 1)))
    rows = hashed.select("doc_id", "th", F.size("h").alias("n"), F.concat(none, F.col("h"), none).alias("hp")).select(
        "*", at.alias("at"))
    rows = rows.withColumn("i", F.expr(f"cast(at div {len(lengths)} as int)")).withColumn(
        "k", F.get(F.array(*[F.lit(k) for k in lengths]), F.col("at") % len(lengths)))
    rows = rows.filter(F.col("i") + F.col("k") <= F.col("n")).withColumn(
        "seed", F.xxhash64("k", F.slice("hp", F.col("i") + WINDOW + 1, F.col("k"))))
    found = None
    for b in range(blocks):
        part = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b)
        start = F.col("i") - F.col("from")
        there = F.slice("hp", start + WINDOW + 1, F.col("item_words"))
        best = F.aggregate(F.zip_with(there, "w", lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int")), F.lit(0),
                           lambda t, x: t + x)
        inside = (start >= 0) & (start + F.col("item_words") <= F.col("n"))     # the place is in the text in whole
        #: The one-row explode keeps the filter out of the join, as below.
        hits = (rows.join(F.broadcast(part.drop("k")), "seed")
                .select("doc_id", "th", "item_id", "item_words", F.explode(F.array(F.struct(
                    start.alias("start"), best.alias("best"), inside.alias("inside")))).alias("x"))
                .select("doc_id", "th", "item_id", "item_words", "x.*")
                .filter(F.col("inside") & (F.col("best") >= needed(F.col("item_words"), share)))
                .select("doc_id", "th", "item_id", "item_words", "start", "best"))
        found = hits if found is None else found.unionByName(hits)
    # both halves of an item find the same place
    return found.groupBy("doc_id", "th", "item_id", "item_words").agg(
        F.max("best").cast("int").alias("best"), F.count_distinct("start").alias("hits"))


def overlaps(docs: DataFrame, benchmark: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """doc_id, th (hash of the text), item_id, item_words, best (most equal words in a window), hits."""
    seeds = item_seeds(benchmark)
    size = seeds.count() * _SEED_BYTES
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    hashed = docs.select("doc_id", text_hash().alias("th"), word_hashes(F.col("text")).alias("h"))
    found = None
    for k in range(blocks):
        part = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == k)
        hits = (_seeds(hashed).join(F.broadcast(part), "seed")
                .select("doc_id", "th", "item_id", "item_words", "b", _around().alias("a")))
        equal = F.zip_with("a", "b", lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int"))
        starts = F.sequence(F.lit(0), F.lit(WINDOW))
        best = F.array_max(F.transform("starts", lambda s: F.aggregate(
            F.slice("equal", s + 1, WINDOW), F.lit(0), lambda t, x: t + x)))
        #: One-row explodes between join and filter: pushed into the join, the filter would end its code generation
        #: and copy a document's words for every position.
        hits = (hits.select("doc_id", "th", "item_id", "item_words", F.explode(F.array(F.struct(
                    equal.alias("equal"), starts.alias("starts")))).alias("x"))
                .select("doc_id", "th", "item_id", "item_words", "x.*")
                .select("doc_id", "th", "item_id", "item_words", F.explode(F.array(best)).alias("best"))
                .filter(F.col("best") >= needed(F.col("item_words"), share))
                .groupBy("doc_id", "th", "item_id", "item_words")
                .agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("hits")))
        found = hits if found is None else found.unionByName(hits)
    if blocks > 1:
        found = found.groupBy("doc_id", "th", "item_id", "item_words").agg(
            F.max("best").alias("best"), F.sum("hits").alias("hits"))
    short = materialize(short_seeds(benchmark))
    lengths = sorted(r["k"] for r in short.select("k").distinct().collect())      # fewer than WINDOW
    if lengths:
        blocks = max(1, math.ceil(short.count() * _SEED_BYTES / BLOCK_BYTES))
        found = found.unionByName(short_overlaps(hashed, short, lengths, blocks, share))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item."""
    keys = overlaps(docs, benchmark, share).select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"))
    return drop_keys(docs, keys.distinct())
