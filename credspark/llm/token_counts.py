"""Token counts by heap-and-linked-list byte-pair merging, for tokenizers with word ends.

A word's symbols stand in a doubly linked list; a heap holds every adjacent
pair that has a merge rank.  The lowest rank (leftmost first) is popped and
merged again and again; entries whose pair has changed meanwhile are skipped.
The count is initial symbols minus merges; no identifiers are made.  A word
of n symbols takes n log n steps, so one very long word is no danger.

Words repeat, so a worker remembers the counts of up to twice CACHE_WORDS
words, which bounds its memory.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
get equal rows; an empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import normalizers

from credspark.llm.common import Memo, Splitter, small_batches

CACHE_WORDS = 200_000
LIMIT = 2048


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else 256 and up."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def merges_of(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges byte-pair encoding makes in ``symbols``."""
    n = len(symbols)
    sym: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 1) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i, j = heapq.heappop(heap)
        if sym[i] is None or after[i] != j or ranks.get((sym[i], sym[j])) != rank:
            continue
        merges += 1
        sym[i] += sym[j]
        sym[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i, k))
        if (h := before[i]) >= 0 and (r := ranks.get((sym[h], sym[i]))) is not None:
            heapq.heappush(heap, (r, h, i))
    return merges


_LOWER = normalizers.Lowercase()    # character by character, by the library's version of Unicode


class WordBpe:
    """The pieces of a tokenizer file (.json) that counting needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        suffix, shown = spec["model"]["end_of_word_suffix"] or "", byte_symbols()

        def tokens(word: str) -> int:
            symbols = [shown[b] for b in word.encode("utf-8", "replace")]
            symbols[-1] += suffix
            return len(symbols) - merges_of(symbols, ranks)

        self.tokens, self.counts = tokens, Memo(tokens, CACHE_WORDS)
        self.words = Splitter(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for p in parts:
            p = p if p.isascii() else unicodedata.normalize("NFC", p)
            p = p.lower() if self.words.is_latin(p) else _LOWER.normalize_str(p)
            for word, n in Counter(self.words(p)).items():
                total += n * (self.counts[word] if len(word) <= 64 else self.tokens(word))
        return total


_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit.  ``path``: a tokenizer file that every worker can read."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [bpe.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
