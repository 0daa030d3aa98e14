"""Periodic runs of words: stretches that repeat a block of words three times or more.

A run is a stretch with smallest period q and length of at least max(24, 3 q)
that no neighbouring word extends.  Its words equal the words q before them over
a stretch of ``length - q`` >= max(24 - q, 2 q) >= 16 words, so a diagonal (lag) can
matter only once 16 words in a row match.  The online diagonal DP therefore takes
the 16 words that end at a place as its symbol: the earlier occurrences of the
symbol name the lags that match there, each adds one to the lag's match length
(16 where the lag was not active), and a lag that no occurrence names any more has
ended and emits its run if it is long enough.  Only symbols that occur twice in a
text are visited, so texts without repeats cost one numpy pass.

Inside a run of period q <= 8 the 16-word symbol recurs only at multiples of q,
which end with the run and are no smallest periods: they are left out by bisection,
so that one word repeated all over stays linear.  Equal stretches of several lags
are one run of the smallest.  Words are compared by 64-bit hashes.

A null text has no words (n = 0) and no run; a null doc_id has no crc32 and its
words stay as they are; repeated rows are each returned; other columns are not
read; an empty table gives no rows.  A text is held by one task in whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credspark.llm.common import Words, mix64, passes, small_batches

#: A run's least length in words and in periods; words that every long enough diagonal matches in a row.
LEAST, TIMES, GRAM = 24, 3, 16

Run = tuple[int, int, int]  # start, length, period


def planted(n: int, h: int) -> np.ndarray:
    """For each word of a text of n words, the word that stands there: texts with h % 10 = 0 repeat a block."""
    at = np.arange(n)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def grams(word: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words that begin at each word (the last GRAM - 1 entries mean nothing)."""
    out, size = mix64(word), 1
    while size < GRAM:
        ahead = np.concatenate((out[size:], np.zeros(min(size, len(out)), np.uint64)))
        out, size = mix64(out * np.uint64(0x9E3779B97F4A7C15) + ahead), size * 2
    return out


def diagonals(places: list[int], symbols: list[int], n: int) -> list[Run]:
    """All runs of a text of ``n`` words from the places (rising) whose 16-word symbol occurs more than once.

    A place is the number of the symbol's last word."""
    seen: dict[int, list[int]] = {}
    active: dict[int, int] = {}
    ended: dict[tuple[int, int], int] = {}
    farthest = n // TIMES
    last = -2

    def end(lag: int, match: int, at: int) -> None:
        if match >= max(LEAST - lag, (TIMES - 1) * lag):
            key = (at - match - lag + 1, match + lag)
            ended[key] = min(ended.get(key, lag), lag)

    for i, symbol in zip(places, symbols):
        if i != last + 1 and active:
            for lag, match in active.items():
                end(lag, match, last)
            active = {}
        before = seen.setdefault(symbol, [])
        now: dict[int, int] = {}
        inside = None
        if before:
            lag = i - before[-1]
            if lag <= farthest:
                now[lag] = match = active.get(lag, GRAM - 1) + 1
                stop = len(before) - 1
                if 2 * lag <= GRAM:     # in a run of a short period: only what begins before the run is new
                    inside = i - match - lag + GRAM
                    stop = min(stop, bisect_left(before, inside))
                for k in range(stop - 1, -1, -1):
                    lag = i - before[k]
                    if lag > farthest:
                        break
                    now[lag] = active.get(lag, GRAM - 1) + 1
        for lag, match in active.items():
            if lag not in now and (inside is None or i - lag < inside):
                end(lag, match, last)
        active, last = now, i
        before.append(i)
    for lag, match in active.items():
        end(lag, match, last)
    return sorted((start, length, period) for (start, length), period in ended.items())


def dropped(runs: list[Run], n: int) -> np.ndarray:
    """Words that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] > 0


def longest(runs: list[Run]) -> Run | None:
    """The run of the greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(texts: list[str | None], hashes: list[int | None]) -> Iterator[tuple[list[Run], bytes]]:
    """For each text its runs and the text without repeated blocks (kept words joined by one space)."""
    w = Words(texts)
    sizes = np.diff(w.borders)
    moved = {d: planted(int(sizes[d]), h) for d, h in enumerate(hashes) if h is not None and h % 10 == 0}
    word = w.hash
    if moved:
        word = word.copy()
        for d, at in moved.items():
            word[w.borders[d]:w.borders[d + 1]] = w.hash[w.borders[d] + at]
    gram = grams(word) + mix64(w.doc.astype(np.uint64) + np.uint64(1))      # a text's own symbols
    whole = np.flatnonzero(np.arange(len(word)) + GRAM <= w.borders[1:][w.doc])
    _, which, times = np.unique(gram[whole], return_inverse=True, return_counts=True)
    again = times[which] > 1
    where, symbol, owner = whole[again], which[again], w.doc[whole[again]]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    for d in range(len(texts)):
        lo, hi = cut[d], cut[d + 1]
        n = int(sizes[d])
        runs = diagonals((where[lo:hi] - w.borders[d] + GRAM - 1).tolist(), symbol[lo:hi].tolist(), n) if hi > lo else []
        words = w.buf[w.starts[d]:w.ends[d] - 1].tobytes().split()      # white space in ASCII
        if d in moved:
            words = [words[k] for k in moved[d]]
        if runs:
            words = [words[k] for k in np.flatnonzero(~dropped(runs, n))]
        yield runs, b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 for every row."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def row(runs: list[Run], text: bytes) -> tuple:
        best = longest(runs)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
        return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.string()] * 2
        for b in batches:
            hashes = b.column(1).to_pylist()
            for start, part in passes(b.column(2).to_pylist()):
                rows = [row(*found) for found in find_runs(part, hashes[start:start + len(part)])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(part)),
                     *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select("doc_id", crc.alias("h"), "text").mapInArrow(
        run, f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
             "runs_sha256 string, collapsed_sha256 string")
