"""Periodic runs against brute force over all periods."""

import hashlib
import re
import zlib

import numpy as np
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from credspark.llm import periodic_runs as R


def brute_runs(words):
    """Every maximal stretch of every period, smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // R.TIMES + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i >= max(R.LEAST - q, (R.TIMES - 1) * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    digest = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def runs_of(words):
    return next(R.find_runs([" ".join(words)], [None]))[0]


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_runs_equal_brute_force(data):
    """Texts put together from repeated blocks over few words, so that periods nest and overlap."""
    words = []
    for _ in range(data.draw(st.integers(1, 6))):
        block = data.draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=14))
        words += block * data.draw(st.integers(1, 12))
    if data.draw(st.booleans()):
        words = words * data.draw(st.integers(1, 4)) + words[:data.draw(st.integers(0, 20))]
    words = words[:700]
    assert runs_of(words) == brute_runs(words)


def test_longer_periods_with_repeats_inside_the_block():
    rng = np.random.default_rng(2)
    for _ in range(60):
        x, y = ([f"w{k}" for k in rng.integers(0, 30, rng.integers(16, 40))] for _ in range(2))
        block = (x + y + x + x + y + y)[:int(rng.integers(20, 200))]
        words = ["head"] * int(rng.integers(0, 30)) + block * int(rng.integers(2, 6)) + block[:5] + x + ["z"] * 30
        assert runs_of(words) == brute_runs(words)


def test_one_word_all_over_is_linear():
    assert runs_of(["same"] * 200_000) == [(0, 200_000, 1)]
    words = (["="] * 500 + ["|"]) * 40
    assert runs_of(words) == brute_runs(words)


def test_operator_equals_brute_force(spark, odd_docs):
    rng = np.random.default_rng(9)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if len(r["text"] or "") < 10_000]
    rows += [(i, " ".join(f"w{k}" for k in rng.integers(0, 3 + i % 50, 5 + i))) for i in range(100, 400)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"), "h", "start", "length", "n_runs")
    out = sorted((tuple(r) for r in R.periodic_runs(docs).collect()), key=str)
    assert out == sorted((brute(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in out) >= 10


def test_empty_table_and_long_text(spark, odd_docs):
    assert R.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert R.periodic_runs(odd_docs).count() == odd_docs.count()
