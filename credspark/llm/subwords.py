"""Subword ids of many words at once: greedy longest match in the vocabulary of a public byte-level tokenizer.

The ids are the file's tokens of at most PIECE bytes (a leading space apart)
without upper-case letters, by rank, the first ``size`` of them; every byte is
one of them.  A word begins with the longest token that starts with a space, or
with the space alone; the rest follows by the longest tokens without a space.
Words of more than PART bytes are cut into parts of PART bytes first, so the
number of steps is bounded.  The ids of a word depend on its bytes only.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np

#: Longest token and longest part of a word in bytes.
PIECE, PART = 4, 64


class Pieces:
    def __init__(self, path: str, size: int):
        with open(path, "rb") as f:
            ranked = sorted((int(r), base64.b64decode(a)) for a, r in map(bytes.split, f))
        tokens = [t for _, t in ranked]
        single = [t for t in tokens if len(t) == 1]
        fits = [t for t in tokens if len(t) > 1 and len(t.removeprefix(b" ")) <= PIECE and t.lower() == t
                and t.split() == [t.removeprefix(b" ")]]
        self.tokens = (single + fits)[:size]
        if len(set(single)) < 256 or size < 256:
            raise ValueError("a token for each byte is needed")
        self.space = self.tokens.index(b" ")
        at_start = [(i, t[1:]) for i, t in enumerate(self.tokens) if len(t) > 1 and t[:1] == b" "]
        inside = [(i, t) for i, t in enumerate(self.tokens) if t[:1] != b" " or t == b" "]
        self.tables = [self._table(inside), self._table(at_start)]

    @staticmethod
    def _table(tokens: list[tuple[int, bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each length from 1 on: sorted codes and their ids."""
        out = []
        for n in range(1, PIECE + 1):
            mine = sorted((int.from_bytes(t, "little"), i) for i, t in tokens if len(t) == n)
            out.append((np.array([c for c, _ in mine], np.int64), np.array([i for _, i in mine], np.int64)))
        return out

    @staticmethod
    def _longest(table, code: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, bytes) of the longest token at the head of ``code`` within ``room`` bytes; -1, 0 where there is none."""
        ids, size = np.full(len(code), -1, np.int64), np.zeros(len(code), np.int64)
        open_ = np.arange(len(code))
        for n in range(PIECE, 0, -1):
            codes, owners = table[n - 1]
            if not len(codes) or not len(open_):
                continue
            head = code[open_] & ((1 << 8 * n) - 1)
            at = np.minimum(np.searchsorted(codes, head), len(codes) - 1)
            hit = (codes[at] == head) & (room[open_] >= n)
            found = open_[hit]
            ids[found], size[found] = owners[at[hit]], n
            open_ = open_[~hit]
        return ids, size

    def __call__(self, buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (borders ``first``, ``last`` in the bytes ``buf``), one word after the other, and their
        number for each word."""
        padded = np.concatenate((buf, np.zeros(PIECE, np.uint8))).astype(np.int64)
        code = sum(padded[k:len(buf) + k] << 8 * k for k in range(PIECE))
        parts = -(-(last - first) // PART)
        word = np.repeat(np.arange(len(first)), parts)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
        place = first[word] + nth * PART
        end = np.minimum(place + PART, last[word])
        taken = np.zeros(len(word), np.int64)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        begins = np.flatnonzero(nth == 0)
        ids, size = self._longest(self.tables[1], code[place[begins]], (end - place)[begins])
        steps.append((begins, np.where(ids < 0, self.space, ids)))
        place[begins] += size
        taken[begins] += 1
        alive = np.flatnonzero(place < end)
        while len(alive):
            ids, size = self._longest(self.tables[0], code[place[alive]], (end - place)[alive])
            steps.append((alive, ids))
            place[alive] += size
            taken[alive] += 1
            alive = alive[place[alive] < end[alive]]
        offset = np.cumsum(taken) - taken
        flat, done = np.empty(int(taken.sum()), np.uint16), np.zeros(len(word), np.int64)
        for part, ids in steps:
            flat[offset[part] + done[part]] = ids
            done[part] += 1
        return flat, np.bincount(word, taken, len(first)).astype(np.int64)


@cache
def pieces(path: str, size: int) -> Pieces:
    return Pieces(path, size)
