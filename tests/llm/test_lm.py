"""Language-model scores: base scores and gradients against brute force, windows, probabilities, odd inputs."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from conftest import clashing

from credspark.llm import attention_model as A
from credspark.llm import lm_scoring as L
from credspark.llm import subwords as S
from credspark.llm.subwords import Pieces

FILE = P.path("byte_bpe_50k.tiktoken")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), None]


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def brute(rows):
    counts = Counter(t for i, text in rows if learned(i) for t in tokens(text))
    total = sum(counts.values())
    return sorted(((i, not learned(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), total,
                    round(sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in tokens(t)), 6))
                   for i, t in rows), key=str)


def result(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    round(r["base_score"], 6)) for r in df.collect()), key=str)


def test_base_scores_equal_brute_force(spark, odd_docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [(i, f"The {'rare' if i % 9 else 'ODD'}{i % 13} Word ÀÉ É é x of the document {i}") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = clashing(docs, "row", "word", "n", "ids", "score")
    assert result(L.lm_scores(docs, FILE)) == brute(rows)
    monkeypatch.setattr(L, "HOT_SHARE", 4)      # nearly every word takes the way of the join
    assert result(L.lm_scores(docs, FILE)) == brute(rows)


def test_empty_table_and_no_training_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.lm_scores(empty, FILE).collect() == []
    out_id = next(i for i in range(100) if not learned(i))
    alone = L.lm_scores(spark.createDataFrame([(out_id, "a b")], "doc_id long, text string"), FILE).first()
    assert (alone["n_known"], alone["train_tokens"], alone["base_score"]) == (0, 0, 0.0)
    assert math.isfinite(alone["score"])


def test_every_id_is_scored_once_with_what_is_before_it():
    ids, sizes = np.arange(100) % 50, np.array([1, 16, 17, 60, 6])
    inputs, targets, text = A.windows(ids, sizes, 50)
    assert targets[targets >= 0].tolist() == ids.tolist()
    starts = np.cumsum(sizes) - sizes
    nth = Counter()
    for row, (shown, wanted) in enumerate(zip(inputs, targets)):
        t = text[row]
        whole = [51] * A.SPAN + [50] + ids[starts[t]:starts[t] + sizes[t]].tolist() + [-9] * A.SPAN
        at = A.SPAN + 1 + nth[t] * A.STEP       # the window's first target
        for place in range(A.STEP):
            if wanted[place] >= 0:
                assert wanted[place] == whole[at + place]
                assert shown[:A.BACK + place + 1].tolist() == whole[at - A.BACK - 1:at + place]
        nth[t] += 1


def small_model(dtype=np.float64):
    rng = np.random.default_rng(3)
    return {k: v.astype(dtype) for k, v in A.initial(rng.integers(0, 40, 90)).items()}


def test_probabilities_of_all_next_ids_sum_to_one_and_see_nothing_ahead():
    p = small_model()
    before = np.array([5, 80, 3, 3, 17])
    both = [A.log_probability(p, np.append(before, k), np.array([6])) for k in range(90)]
    prefix = A.log_probability(p, before, np.array([5]))
    assert math.isclose(sum(math.exp(b[0] - prefix[0]) for b in both), 1.0, rel_tol=1e-5)


def test_gradient_equals_differences():
    p, rng = small_model(), np.random.default_rng(4)
    inputs, targets, _ = A.windows(rng.integers(0, 90, 70), np.array([40, 1, 29]), 90)
    _, grad = A.gradient(p, inputs, targets)
    for name, values in p.items():
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in values.shape)
            if name == "id_bias" and values[at] < -1e8:     # no id there
                continue
            old, losses = values[at], []
            for step in (1e-5, -1e-5):
                values[at] = old + step
                losses.append(A.gradient(p, inputs, targets)[0])
            values[at] = old
            assert math.isclose((losses[0] - losses[1]) / 2e-5, grad[name][at], rel_tol=1e-3, abs_tol=1e-6), name


def test_training_lowers_held_out_loss(make_docs, words):
    """Texts in which one word decides the next: the model must beat its start (single ids) on unseen texts."""
    follow = {w: words(1)[0] for w in set(words(40))}
    rng = np.random.default_rng(8)
    heads = list(follow)
    rows = [(i, " ".join(x for w in rng.integers(0, len(heads), 120) for x in (heads[w], follow[heads[w]])))
            for i in range(300)]
    docs = make_docs(rows)
    out = L.lm_scores(docs, FILE, share=1).collect()
    start = L.lm_scores(docs, FILE, rounds=0).collect()
    per = lambda r: sum(x["score"] for x in r if x["held_out"]) / sum(x["n_subwords"] for x in r if x["held_out"])
    assert per(out) > per(start) * 0.6


def test_parameters_survive_packing():
    p = small_model(np.float32)
    again = A.views(A.pack(p), p)
    assert all(np.array_equal(p[k], again[k]) for k in p)


@pytest.mark.parametrize("size", [256, 700, 2047])
def test_subwords_are_the_longest_matches(size):
    cut = Pieces(FILE, size)
    assert len(cut.tokens) == len(set(cut.tokens)) == size
    rng = np.random.default_rng(7)
    texts = ["the and of ération ğ日本 " + " ".join("".join("abeinrst."[k] for k in rng.integers(0, 9, n)) for n in range(1, 90))]
    texts.append("x" * 1000 + "th" * 150)
    w = L.lower_words(texts)
    ids, length = cut(w.buf, w.first, w.last)
    at = 0
    for i, j, n in zip(w.first, w.last, length):
        word, want = w.buf[i:j].tobytes(), []
        for lo in range(0, len(word), S.PART):
            part = word[lo:lo + S.PART]
            while part or (lo == 0 and not want):
                first = lo == 0 and not want
                fits = [k for k in range(min(S.PIECE, len(part)), -1, -1)
                        if (b" " * first + part[:k] if first or k else None) in cut.tokens
                        and (first or part[:k] == b" " or part[:1] != b" ")]
                want.append(cut.tokens.index(b" " * first + part[:fits[0]]))
                part = part[fits[0]:]
        assert ids[at:at + n].tolist() == want
        assert b"".join(cut.tokens[x] for x in want) == b" " + word
        at += n
    assert at == len(ids)


def test_number_of_subwords(make_docs):
    cut = Pieces(FILE, L.SUBWORDS)
    for text in ("", None, "One two", "é" * 5000, "word " * 3000):
        w = L.lower_words([text])
        want = int(cut(w.buf, w.first, w.last)[1].sum()) + 1
        assert L.lm_scores(make_docs([(0, text)]), FILE, rounds=0).first()["n_subwords"] == want


def test_every_window_is_trained_on(spark):
    """By default each id of the training rows of a round is a target once."""
    import pyarrow as pa

    ids = [np.arange(n, dtype=np.uint16) % 7 for n in (1, 16, 17, 400)]
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([0, 1, 2, 3])], ["ids", "row"])
    run = L._trainer(A.initial(np.ones(8)), 8, L.SHARE, 0.01, 1)
    assert [b.column(1).to_pylist() for b in run(iter([batch]))] == [[434]]


def peak(work):
    """Most bytes that ``work`` holds at a time beyond what was there."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_windows_are_cut_without_tables_of_places():
    """Time goes with the memory that is written: little more than the windows themselves."""
    sizes = np.random.default_rng(2).integers(1, 400, 400)
    ids = np.arange(sizes.sum(), dtype=np.int64) % 50
    inputs, targets, _ = A.windows(ids, sizes, 50)
    assert peak(lambda: A.windows(ids, sizes, 50)) < 2 * (inputs.nbytes + targets.nbytes)


def test_a_gradient_step_works_in_arrays_it_keeps():
    rng = np.random.default_rng(6)
    t = A.Trainer(A.initial(rng.integers(0, 40, 2048)), 0.01)
    inputs, targets, _ = A.windows(rng.integers(0, 2048, A.BATCH * A.STEP), np.array([A.BATCH * A.STEP]), 2048)
    t.fit(inputs, targets)
    assert peak(lambda: t.fit(inputs, targets)) < targets.size * 4 * (A.CLASS + A.WIDTH)


def test_texts_without_ids_have_no_windows():
    ids, sizes = np.arange(33), np.array([0, 16, 0, 1, 16, 0])
    inputs, targets, text = A.windows(ids, sizes, 50)
    assert text.tolist() == [1, 3, 4] and targets[targets >= 0].tolist() == ids.tolist()
    assert [row[A.BACK - 1:A.BACK + 2].tolist() for row in inputs] == [[51, 50, 0], [51, 50, 16], [51, 50, 17]]
    assert [len(x) for x in A.windows(ids[:0], sizes[:1], 50)] == [0, 0, 0]


def test_columns_of_odd_repeats_are_summed_by_id():
    rows, ids = np.arange(40.0, dtype=np.float32).reshape(10, 4), np.array([3, 0, 3, 3, 1, 0, 5, 5, 1, 3])
    out = np.full((6, 4), 9, np.float32)
    A._spread(rows, ids, out, A.Room().of({"seen": out}))
    assert out.tolist() == [rows[ids == k].sum(axis=0).tolist() for k in range(6)]
