"""Pieces shared by the operators of this package.

Documents are identified inside an operator by ``doc_key``: the pair
(doc_id, xxhash64(text)).  Rows with a repeated doc_id but another text stay
apart, and a repeated row gets the decision of its twin.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

#: Bytes of text that one numpy pass handles; larger single texts get a pass of their own.
PASS_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: Column | str = "text") -> Column:
    """64-bit hash of a text; a null text has a hash of its own."""
    c = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(c, F.lit("")), c.isNull())


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of few rows, so that long texts fit the Python workers' memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def drop_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text hash) is in ``keys`` (k_id, k_th)."""
    tagged = docs.withColumn("_llm_th", text_hash())
    cond = tagged["doc_id"].eqNullSafe(keys["k_id"]) & (tagged["_llm_th"] == keys["k_th"])
    return tagged.join(keys, cond, "left_anti").drop("_llm_th")


class Memo(dict):
    """Remembers ``compute(key)`` of up to twice ``limit`` keys; those in use survive when it is full."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


#: Characters of most Latin texts: ASCII and letters, for which the classes below are exact.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_CLASSES = {r"\p{L}": "A-Za-z" + _LATIN, r"\p{N}": "0-9", r"\s": r"\t-\r "}


class Splitter:
    """All matches of a pattern with \\p{L}, \\p{N}, \\s and \\S, by the faster ``re`` where a text is Latin.

    Other texts are split by the tokenizer library's own engine: which characters
    are letters depends on a library's version of Unicode.
    """

    def __init__(self, pattern: str):
        self.library = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        out, inside, i = "", False, 0
        while i < len(pattern):
            name = next((c for c in _CLASSES if pattern.startswith(c, i)), None)
            if name:
                out += _CLASSES[name] if inside else f"[{_CLASSES[name]}]"
            elif pattern.startswith(r"\S", i):
                name, out = r"\S", out + "[^" + _CLASSES[r"\s"] + "]"
            else:
                name = pattern[i]
                inside = {"[": True, "]": False}.get(name, inside)
                out += name
            i += len(name)
        self.latin = re.compile(out)
        self.is_latin = re.compile(f"[\x00-\x7f{_LATIN}]*").fullmatch

    def __call__(self, text: str) -> list[str]:
        return self.latin.findall(text) if self.is_latin(text) else self.any(text)

    def any(self, text: str) -> list[str]:
        return [piece for piece, _ in self.library.pre_tokenize_str(text)]


# ------------------------------------------------------------- bytes in numpy

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PASS_BYTES + 4096)
        for name, base in (("up", _MULT), ("down", _INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"][:n], _powers["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers, so that similar inputs give unlike outputs."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Bytes between words: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


#: Bytes between words where punctuation counts too: ASCII that is neither letter nor digit.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Words:
    """Words (runs of bytes between ``breaks``) of a list of texts, in numpy arrays.

    buf: all bytes, texts separated by one newline; first, last: borders of each
    word in buf; doc: index of its text; hash: 64-bit hash of its bytes.
    """

    def __init__(self, texts: list[str | None], breaks: np.ndarray = SPACE):
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        self.buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        sizes = np.fromiter((len(r) for r in raw), np.int64, len(raw))
        self.ends = np.cumsum(sizes + 1)
        self.starts = self.ends - sizes - 1
        word = ~breaks[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
        self.first, self.last = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.ends, self.first, side="right")
        self.borders = np.searchsorted(self.first, np.concatenate((self.starts, self.ends[-1:])))
        self._hash: np.ndarray | None = None

    def prefix_sums(self) -> np.ndarray:
        up, _ = _pow(len(self.buf))
        sums = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        return sums

    def hash_spans(self, first: np.ndarray, last: np.ndarray, sums: np.ndarray) -> np.ndarray:
        _, down = _pow(len(self.buf))
        return mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.hash_spans(self.first, self.last, self.prefix_sums())
        return self._hash


def passes(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of ``texts`` of about PASS_BYTES: (index of the first, texts)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > PASS_BYTES // 2:
            yield start, texts[start:i]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, texts[start:]


#: Longest text in bytes that a classifier is trained on; with the number of documents it bounds the sample.
TRAIN_BYTES = 50_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, longest: int = TRAIN_BYTES) -> DataFrame:
    """text and label of ``most`` labelled documents at most, picked by a hash of doc_id; texts over ``longest`` bytes stay out.

    The ids are few (``most``), so they are broadcast and documents stay where they are.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("_llm_y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    return texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", F.col("_llm_y").alias("y"))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words of one text; a shorter text is one run."""
    if not len(words):
        return words
    m = max(1, len(words) - n + 1)
    out = np.zeros(m, np.uint64)
    for k in range(min(n, len(words))):
        out = out * np.uint64(_MULT) + words[k: k + m]
    return np.unique(mix64(out))
