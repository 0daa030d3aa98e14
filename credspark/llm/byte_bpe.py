"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is one valid encoding, so its last token
alone describes it: ``last[i]`` is the token that ends the encoding of the
first i bytes, and the whole encoding is read by walking back from the end.
A token may follow another where byte-pair merging of their joined bytes
gives just these two; a sequence is an encoding where each token may follow
the one before it.  Because ``last`` holds every prefix, appending bytes only
fills in new entries, and a replaced stretch only recomputes entries until
they agree again with the old ones.

Defined results: null and empty texts give no tokens and empty bytes; lone
surrogates cannot occur in UTF-8 columns; repeated rows give equal rows; an
empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from credspark.llm.common import Memo, Splitter, small_batches

#: Half of the pieces and token pairs that a worker remembers at most.
CACHE_PIECES, CACHE_PAIRS = 400_000, 500_000


class Vocabulary:
    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes = {r: t for t, r in self.ranks.items()}
        self.text = {r: str(r) for r in self.bytes}
        self.longest = max(map(len, self.ranks))
        #: Tokens by their bytes from the last to the first: byte -> next node, -1 -> token or None.
        self.endings: dict = {-1: None}
        for token, rank in self.ranks.items():
            if len(token) > 1 and len(self.merge(token)) > 1:
                continue    # no merging ever makes this token
            node = self.endings
            for byte in reversed(token):
                node = node.setdefault(byte, {-1: None})
            node[-1] = rank
        self.size = max(self.bytes) + 1
        self.may_follow = Memo(self._may_follow, CACHE_PAIRS)

    def merge(self, data: bytes) -> list[bytes]:
        """Byte-pair merging as defined: lowest rank first, leftmost among equals."""
        parts = [data[i: i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, pair: int) -> bool:
        """Whether the token ``pair % size`` may follow the token ``pair // size``."""
        left, right = self.bytes[pair // self.size], self.bytes[pair % self.size]
        return self.merge(left + right) == [left, right]


class Prefixes:
    """Bytes with the last token of each prefix.  ``append`` and ``replace`` keep it exact."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _token_at(self, end: int) -> int:
        """The one token that validly ends the first ``end`` bytes; shorter endings are tried first."""
        data, last, node, at = self.data, self.last, self.v.endings, end
        size, may_follow = self.v.size, self.v.may_follow
        while at:
            at -= 1
            node = node.get(data[at])
            if node is None:
                break
            token = node[-1]
            if token is not None and (at == 0 or may_follow[last[at] * size + token]):
                return token
        raise ValueError(f"byte {data[end - 1]} has no token")

    def append(self, more: bytes) -> None:
        at = len(self.data)
        self.data += more
        for end in range(at + 1, len(self.data) + 1):
            self.last.append(self._token_at(end))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of bytes start to end; returns how many entries were computed.

        An entry depends on the ``longest`` bytes and entries before it, so after
        that many unchanged entries in a row the rest of the old ones hold.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        settled = start + len(new)
        same = 0
        for at in range(start + 1, len(self.data) + 1):
            token = self._token_at(at)
            self.last.append(token)
            same = same + 1 if at > settled and token == old[at - shift] else 0
            if same > self.v.longest:
                self.last += old[at - shift + 1:]
                return at - start
        return len(self.data) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.v.bytes[self.last[end]])
        return out[::-1]


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.v, self.pattern = Vocabulary(path), Splitter(pattern)
        self.ids = Memo(lambda piece: Prefixes(self.v, piece.encode("utf-8", "replace")).tokens(), CACHE_PIECES)

    def encode(self, text: str) -> list[int]:
        """The ids of a text: each match of the pattern by itself, pieces seen before by memory."""
        pieces = self.pattern(text)
        if pieces and max(map(len, pieces)) > 1000:     # not worth remembering
            return list(chain.from_iterable(
                self.ids[p] if len(p) <= 1000 else self.ids.compute(p) for p in pieces))
        return list(chain.from_iterable(map(self.ids.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes.__getitem__, ids))


_loaded: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Encoder(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (token ids of the whole text), decoded (bytes of the decoded ids)."""
    return _run(docs, path, pattern, lambda e, ids: (ids, e.decode(ids)),
                [("ids", "array<int>", pa.list_(pa.int32())), ("decoded", "binary", pa.binary())])


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoding and decoding each text."""
    def digests(e: Encoder, ids: list[int]) -> tuple[int, str, str]:
        joined = " ".join(map(e.v.text.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(e.decode(ids)).hexdigest()

    return _run(docs, path, pattern, digests,
                [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()),
                 ("decoded_sha256", "string", pa.string())])


def _run(docs: DataFrame, path: str, pattern: str, result, columns: list) -> DataFrame:
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            rows = [result(e, e.encode(t or "")) for t in b.column(1).to_pylist()]
            out = [pa.array([r[k] for r in rows], kind) for k, (_, _, kind) in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], ["doc_id", *[c[0] for c in columns]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t, _ in columns))
