"""Language-model scores of whole texts: a causal self-attention model over subword ids.

``lm_scores`` learns from the training documents and scores all:

1. Word counts of the training documents (one aggregate over hashed words,
   written).  Words with more than 1 / HOT_SHARE of all occurrences are fewer
   than HOT_SHARE, so they may be broadcast; every other word is joined.
2. One pass over the texts cuts lower-cased words into subword ids (``subwords``:
   longest match in a public tokenizer's vocabulary; the file is a parameter) and
   writes a row for each document: ids, sums over hot words, its other words.
3. ``ROUNDS`` rounds train the model on the written ids: a document belongs to
   one round, all its windows are taken (``share``: every so many-th of them, a caller's choice),
   each task trains from the last round's parameters, and their mean, weighted
   by windows and merged in two levels, goes to the next round.
4. Every text is scored by overlapping windows; each id is a target once.

The number of windows trained on, the words counted and the model's input grow
with the corpus.  Words are compared by 64-bit hashes.  ``held_out``: crc32 of
the id as text, modulo 7, is 2; a null id is never held out.  A null or empty
text has the end token alone.  Repeated rows are scored each; other columns of
``docs`` are not read, so their names cannot clash.  An empty table gives no
rows; without training documents every count is 0 and the model keeps its
starting parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark.llm import attention_model as A
from credspark.llm.common import Words, passes, small_batches
from credspark.llm.subwords import Pieces, pieces
from credspark.session import scratch

#: Words with more than 1 / HOT_SHARE of all occurrences are broadcast; there are fewer than HOT_SHARE.
HOT_SHARE = 1 << 20
#: Words that a task adds up before it sends them on.
GATHERED = 4_000_000
#: Subword ids, rounds of training, the share of windows trained on, rate of the first and last round.
SUBWORDS, ROUNDS, SHARE, RATE, LAST_RATE = 2047, 4, 1, 0.01, 0.002


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """A seventh of all ids, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def lower_words(texts: list[str | None]) -> Words:
    """Words of the texts with A-Z lower-cased."""
    w = Words(texts)
    w.buf = _LOWER[w.buf]       # a word's hash is taken from these bytes when it is first asked for
    return w


# ------------------------------------------------------------------ counts

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): 64-bit hashes of the words of the training texts and their counts, written once."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        word, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word)
        word, n = word[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        return word[first], np.add.reduceat(n, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []     # a task adds up its own words, GATHERED at a time
        for b in chain(batches, (None,)):
            for _, part in passes(b.column(0).to_pylist() if b else []):
                parts.append(np.unique(lower_words(part).hash, return_counts=True))
            if (b is None or sum(len(w) for w, _ in parts) > GATHERED) and sum(len(w) for w, _ in parts):
                word, n = merged(parts)
                parts = []
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

    texts = docs.filter(~held_out(F.col("doc_id"))).select("text")
    return _kept(texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")


def _kept(df: DataFrame, tag: str) -> DataFrame:
    path = scratch(df.sparkSession, f"lm-{tag}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- encoding

def _texts(docs: DataFrame, hot: pd.DataFrame, path: str, size: int) -> DataFrame:
    """A row for each document: row, doc_id, held_out, n_tokens, sums over hot words (hot_log, hot_known),
    its other words (rare, times) and its subword ids as 16-bit numbers, the text's end last."""
    hot = hot.sort_values("word")
    hot_word, hot_n = hot["word"].to_numpy(np.int64), hot["n"].to_numpy(np.float64)
    names = ["doc_id", "held_out", "n_tokens", "hot_log", "hot_known", "rare", "times", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, part in passes(b.column(2).to_pylist()):
                yield encoded(b.slice(start, len(part)), lower_words(part), pieces(path, size))

    def encoded(b: pa.RecordBatch, w: Words, cut: Pieces) -> pa.RecordBatch:
        docs_here = b.num_rows
        word, where, which = np.unique(w.hash.view(np.int64), return_index=True, return_inverse=True)
        flat, length = cut(w.buf, w.first[where], w.last[where])
        flat, length = np.append(flat, np.uint16(size)), np.append(length, 1)      # the end of a text
        # every text's words in order, and one end after them
        item = np.full(len(which) + docs_here, len(word), np.int64)
        item[np.arange(len(which)) + w.doc] = which
        long, begin = length[item], (np.cumsum(length) - length)[item]
        ids = flat[np.repeat(begin - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))]
        ends = np.concatenate(([0], np.cumsum(long)))[w.borders + np.arange(docs_here + 1)]
        at = np.minimum(np.searchsorted(hot_word, word), max(len(hot_word) - 1, 0))
        is_hot = hot_word[at] == word if len(hot_word) else np.zeros(len(word), bool)
        log = np.where(is_hot, np.log10(hot_n[at] + 1), 0.0) if len(hot_word) else np.zeros(len(word))
        common = is_hot[which]
        # the other words of each text, with their counts
        rare, owner = which[~common], w.doc[~common]
        pair, times = np.unique(owner * (len(word) + 1) + rare, return_counts=True)
        owner, rare = pair // (len(word) + 1), pair % (len(word) + 1)
        first = pa.array(np.searchsorted(owner, np.arange(docs_here + 1)), pa.int32())
        n = np.bincount(w.doc, minlength=docs_here)
        return pa.RecordBatch.from_arrays([
            b.column(0), b.column(1), pa.array(n + 1, pa.int64()),
            pa.array(np.bincount(w.doc, log[which], docs_here).astype(np.float64)),
            pa.array(np.bincount(w.doc, common, docs_here).astype(np.int64)),
            pa.ListArray.from_arrays(first, pa.array(word[rare])), pa.ListArray.from_arrays(first, pa.array(times)),
            pa.Array.from_buffers(pa.binary(), docs_here, [None, pa.py_buffer((ends * 2).astype(np.int32).tobytes()),
                                                           pa.py_buffer(ids.tobytes())])], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens bigint, hot_log double, hot_known bigint, "
             "rare array<bigint>, times array<bigint>, ids binary")
    return _kept(out.withColumn("row", F.monotonically_increasing_id()), "texts")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = [x.as_buffer() for x in column]
    return (np.frombuffer(b"".join(raw), np.uint16).astype(np.int64),
            np.fromiter((x.size // 2 for x in raw), np.int64, len(raw)))


def _slices(b: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` ids (column 0), so that long texts do not meet in memory."""
    start, size = 0, 0
    for i, x in enumerate(b.column(0)):
        n = x.as_buffer().size // 2
        if i > start and size + n > most:
            yield b.slice(start, i - start)
            start, size = i, 0
        size += n
    if b.num_rows > start:
        yield b.slice(start)


# ---------------------------------------------------------------- training

def _id_counts(texts: DataFrame, n: int) -> np.ndarray:
    """Occurrences of every subword id in the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for b in batches:
            for part in _slices(b):
                total += np.bincount(_ids(part.column(0))[0], minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], ["id", "n"])

    out = np.zeros(n)
    counted = texts.filter(~F.col("held_out")).select("ids").mapInArrow(run, "id bigint, n bigint")
    for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():    # one row for each subword id
        out[r["id"]] = r["n"]
    return out


def _weighted_mean(rows: pd.DataFrame) -> pd.DataFrame:
    total, mean = 0, 0.0
    for flat, weight in zip(rows["flat"], rows["weight"]):
        total += weight
        mean = mean + (np.frombuffer(flat, np.float32).astype(np.float64) - mean) * (weight / total)
    return pd.DataFrame({"flat": [np.float32(mean).tobytes()], "weight": [total]})


def train(texts: DataFrame, n: int, share: int = SHARE, rounds: int = ROUNDS, seed: int = 11) -> A.Params:
    """Parameters after all rounds over the training rows of the written ``texts``."""
    p = A.initial(_id_counts(texts, n), seed)
    learned = texts.filter(~F.col("held_out")).select("ids", "row")
    spread = max(1, math.isqrt(learned.rdd.getNumPartitions()))
    for k in range(rounds):
        rate = RATE * (LAST_RATE / RATE) ** (k / max(rounds - 1, 1))
        mine = learned.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == k)
        sent = mine.mapInArrow(_trainer(p, n, share, rate, seed + k), "flat binary, weight bigint")
        sent = sent.withColumn("branch", F.spark_partition_id() % spread)
        merged = sent.groupBy("branch").applyInPandas(_weighted_mean, "flat binary, weight bigint").toPandas()
        if len(merged):     # one row for each branch
            p = A.views(np.frombuffer(_weighted_mean(merged)["flat"][0], np.float32), p)
    return p


def _trainer(p: A.Params, n: int, share: int, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, rng = A.Trainer(p, rate), np.random.default_rng(seed)
        for b in batches:
            for part in _slices(b):
                ids, sizes = _ids(part.column(0))
                inputs, targets, text = A.windows(ids, sizes, n)
                row = part.column(1).to_numpy()
                nth = np.arange(len(text)) - np.searchsorted(text, text)
                taken = rng.permutation(np.flatnonzero((nth + row[text]) % share == 0))
                for lo in range(0, len(taken), A.BATCH):
                    t.fit(inputs[taken[lo:lo + A.BATCH]], targets[taken[lo:lo + A.BATCH]])
        if t.targets:
            yield pa.RecordBatch.from_arrays([pa.array([t.flat.tobytes()], pa.binary()),
                                              pa.array([t.targets], pa.int64())], ["flat", "weight"])

    return run


# ----------------------------------------------------------------- scoring

def _scored(texts: DataFrame, p: A.Params) -> DataFrame:
    """``texts`` without ids and rare words, with ``score`` (log10) and ``n_subwords``."""
    keep = ["row", "doc_id", "held_out", "n_tokens", "hot_log", "hot_known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                ids, sizes = _ids(part.column(0))
                score = A.log_probability(p, ids, sizes) / math.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(score), pa.array(sizes)],
                                                 [*keep, "score", "n_subwords"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*keep).schema)
    return texts.select("ids", *keep).mapInArrow(run, f"{fields}, score double, n_subwords bigint")


def lm_scores(docs: DataFrame, path: str, size: int = SUBWORDS, share: int = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_subwords for every row.

    ``path``: a file of byte-level tokens and ranks that every worker can read."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    counts = word_counts(docs)
    ends = docs.filter(~held_out(F.col("doc_id"))).count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("word")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    hot = counts.filter(F.col("n") > F.lit(total // HOT_SHARE)).toPandas()     # fewer than HOT_SHARE rows
    texts = _texts(docs, hot, path, size)
    scored = _scored(texts, train(texts, size + 1, share, rounds))
    each = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), "x.times")
    cold = counts.filter(F.col("n") <= F.lit(total // HOT_SHARE))
    rare = each.join(cold, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"), F.sum("times").alias("rare_known"))
    base = (F.col("hot_log") + F.coalesce("rare_log", F.lit(0.0)) + math.log10(ends + 1)
            - F.col("n_tokens") * math.log10(total + distinct + 1))
    known = F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", "n_subwords")
