"""Sharding, near duplicates, line dedup, classifiers and the pipeline: brute force and odd inputs."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from credspark.llm import line_dedup as L
from credspark.llm import near_duplicates as N
from credspark.llm import quality_mil as M
from credspark.llm import queries as Q
from credspark.llm import sharding as S
from credspark.llm import toxicity as X

SF = SF_SMALL.replace("0.001", "0.01")


# ------------------------------------------------------------------ sharding

def check_shards(rows, docs, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert len(rows) == len(docs) and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sharding_query(spark):
    rows = Q.op2_sharding(spark, SF).collect()
    docs = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_shards(rows, docs, 16)
    load, of_text = defaultdict(int), defaultdict(set)
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        assert r["grown_shard"] is None
        load[r["shard"]] += r["size"]
        of_text[docs[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    assert max(load.values()) < 1.1 * min(load.values())


def test_sharding_with_a_third_in_one_group(make_docs):
    docs = [(i, "hot text") for i in range(500)] + [(i, f"text {i} " * (i % 37)) for i in range(500, 1500)]
    rows = S.shard_documents(make_docs(docs), 4).collect()
    check_shards(rows, docs, 4)
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.1 * min(load.values())
    assert S.shard_documents(make_docs(docs), 4).exceptAll(S.shard_documents(make_docs(docs), 4)).count() == 0


def test_sharding_with_many_packers(make_docs, monkeypatch):
    monkeypatch.setattr(S, "GROUPS_PER_PACKER", 100)
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 50)
    docs = [(i, f"text {i} " * (1 + i % 5)) for i in range(1200)]
    rows = S.shard_documents(make_docs(docs), 8).collect()
    check_shards(rows, docs, 8)


def test_sharding_odd_inputs(odd_docs):
    odd = odd_docs.withColumn("g", F.lit(1)).withColumn("shard", F.lit(7)).withColumn("size", F.lit("x"))
    rows = S.shard_documents(odd).collect()
    check_shards(rows, odd.collect(), 16)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert S.shard_documents(odd.limit(0)).count() == 0


# ----------------------------------------------------------- near duplicates

def brute_links(docs):
    """Number of links of each row, and the smallest id of its group."""
    sets = [set(s.tolist()) for s in N.shingle_sets([t for _, t in docs])]
    n = len(docs)
    degree, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            both = len(sets[a] & sets[b])
            if both and both * 10 >= 8 * (len(sets[a]) + len(sets[b]) - both):
                degree[a] += 1
                degree[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    ids = [i for i, _ in docs]
    low = {}
    for k in range(n):
        low[find(k)] = min(low.get(find(k), ids[k]), ids[k])
    return degree, [low[find(k)] for k in range(n)]


@pytest.fixture(scope="module")
def copies(words, rng):
    """A large group of near copies with many edits, small groups, exact copies and texts of their own."""
    base, docs = words(150), []
    for _ in range(90):
        w = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            w[at] = f"edit{rng.integers(0, 10**6)}"
        docs.append(" ".join(w))
    docs += [docs[0]] * 20
    for _ in range(15):
        w = words(60)
        docs += [" ".join(w), " ".join([*w[:-2], "z", "z"]), " ".join(w).upper(), " ".join(w[:30])]
    docs += [" ".join(words(40)) for _ in range(40)] + ["a b", "A  b", "c", "", None, " \n"]
    return [(int(i), docs[k]) for i, k in enumerate(rng.permutation(len(docs)))]


@pytest.mark.parametrize("block", [256, 8])
def test_links_equal_brute_force(make_docs, copies, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    degree, group = brute_links(copies)
    rows = {r["doc_id"]: r for r in N.links(make_docs(copies)).collect()}
    got = [rows[i]["n_links"] for i, _ in copies]
    assert sum(got) >= 0.999 * sum(degree) and all(a <= b for a, b in zip(got, degree))
    assert [rows[i]["class_id"] for i, _ in copies] == group
    kept = {r["doc_id"] for r in N.one_of_each(make_docs(copies)).collect()}
    assert kept == {g for g in group}


def test_prefixes_are_shortened_until_the_target(make_docs, copies, monkeypatch):
    tried = []
    real = N._keyed
    monkeypatch.setattr(N, "_keyed", lambda c, depth: tried.append(depth) or real(c, depth))
    degree, _ = brute_links(copies)
    rows = {r["doc_id"]: r for r in N.links(make_docs(copies), target=0.999999).collect()}
    assert len(tried) > 1 and tried == sorted(tried, reverse=True)
    assert sum(rows[i]["n_links"] for i, _ in copies) == sum(degree)


def test_near_duplicates_odd_inputs(odd_docs):
    odd = odd_docs.withColumn("d", F.lit(1)).withColumn("cls", F.lit(2)).withColumn("key", F.lit(3))
    rows = N.links(odd).collect()
    assert len(rows) == odd.count()
    assert {r["n_links"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert sorted(r["n_links"] for r in rows if r["doc_id"] in (4, 6)) == [0, 2, 2, 2]
    out = N.one_of_each(odd)
    assert out.columns == odd.columns and out.count() == odd.count() - 2
    assert N.links(odd.limit(0)).count() == 0 and N.one_of_each(odd.limit(0)).count() == 0


def test_class_id_of_a_group_whose_first_id_is_null(make_docs):
    text = " ".join(f"w{i}" for i in range(100))
    docs = [(None, text), (7, text), (3, text + " x"), (4, "alone")]
    got = {r["doc_id"]: (r["class_id"], r["group_size"]) for r in N.links(make_docs(docs)).collect()}
    assert got == {None: (3, 3), 7: (3, 3), 3: (3, 3), 4: (4, 1)}


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 60).selectExpr("id as u", "id - 1 as v")
    assert {(r["v"], r["root"]) for r in N.components(edges).collect()} == {(i, 0) for i in range(1, 60)}


# ---------------------------------------------------------------- line dedup

@pytest.fixture(scope="module")
def shared_lines(words, rng):
    passages = [[" ".join(words(n)) for n in sizes] for sizes in ([60], [20, 20], [8] * 6, [12], [29])]
    docs = []
    for i in range(80):
        lines = [" ".join(words(int(n))) for n in rng.integers(1, 25, 8)]
        for k in rng.permutation(5)[: i % 4]:
            at = int(rng.integers(0, len(lines)))
            lines[at:at] = passages[k] if i % 2 else [*passages[k][:2], "", *passages[k][2:]]
        docs.append((i, "\n".join(lines)))
    return docs + [(80, docs[3][1]), (81, "\n".join(reversed(docs[7][1].split("\n"))))]


def test_line_dedup_leaves_no_repeated_run(make_docs, shared_lines):
    out = {r["doc_id"]: r for r in L.line_dedup(make_docs(shared_lines), gone_as="gone").collect()}
    seen = {}
    for i, text in shared_lines:
        lines, gone = text.split("\n"), set(out[i]["gone"])
        assert out[i]["text"] == "\n".join(x for k, x in enumerate(lines) if k not in gone)
        h, words, at = L.line_arrays(text)
        repeated = set()
        for key, first in L.runs(h, words, L.MIN_WORDS):
            have, k = 0, first
            while have < L.MIN_WORDS:
                have += words[k]
                k += 1
            if seen.setdefault(key, i) != i:
                repeated |= set(at[first:k])
        assert repeated <= gone
        blank = {k for k, x in enumerate(lines) if not x.strip()}
        assert gone <= repeated | blank | {a for a in gone if repeated}
    assert out[80]["text"] == ""


def test_line_dedup_finds_rare_lines_between_edits(make_docs, words):
    shared = [" ".join(words(9)) for _ in range(6)]
    mixed = lambda lines: [x for s in lines for x in (s, " ".join(words(15)))]
    texts = [mixed(shared), mixed(shared), mixed(shared[:3]), mixed(shared[3:] + shared[:3])]
    common = " ".join(words(9))
    texts += [[common, " ".join(words(5)), common + " b", " ".join(words(5)), *[common + f" {k}" for k in range(3)]]
              for _ in range(2 * L.RARE_DOCS)]
    docs = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    for k in range(4, len(docs)):     # the common lines never stand together
        lines = docs[k][1].split("\n")
        docs[k] = (k, "\n".join(x for s in lines for x in (s, f"only {k} {len(s)}")))
    gone = {r["doc_id"]: r["gone"] for r in L.line_dedup(make_docs(docs), gone_as="gone").collect()}
    assert gone[0] == [] and gone[1] == [0, 2, 4, 6, 8, 10]
    assert gone[2] == []        # 27 words
    assert gone[3] == [0, 2, 4, 6, 8, 10]
    assert all(gone[i] == [] for i in range(4, len(docs)))


def test_patience_matches_equal_lines_in_order():
    a, b = list("abcdxefg"), list("abydcefg")
    pairs = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
    assert all(p[1] < q[1] for p, q in zip(pairs, pairs[1:])) and len(pairs) == 6
    assert L.patience([], b) == [] and len(L.patience(list("aaaa"), list("aaa"))) == 3


def test_line_dedup_odd_inputs(odd_docs, make_docs, words):
    odd = odd_docs.withColumn("runs", F.lit(1)).withColumn("gone", F.lit(2)).withColumn("lines", F.lit(3))
    out = L.line_dedup(odd)
    assert out.columns == odd.columns and out.exceptAll(odd).count() == 0 and out.count() == odd.count()
    assert L.line_dedup(odd.limit(0)).count() == 0
    text = "\n".join(" ".join(words(40)) for _ in range(3))
    rows = L.line_dedup(make_docs([(None, text), (1, text), (1, text), (2, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows if r["doc_id"] != 2) == [(0, text), (1, ""), (1, "")]


# --------------------------------------------------------------- classifiers

def test_quality_held_out(spark):
    rows = Q.op3_quality_mil(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in tested]) > 0.9


def test_mil_gradient():
    """The learned steps follow the loss: numeric and analytic directions agree."""
    rng = np.random.default_rng(1)
    x, first = rng.standard_normal((40, M.FEATURES)).astype(np.float32), np.arange(0, 40, 4)
    y = (x[first, 0] > 0).astype(np.float32)
    model = M.Mil(np.zeros(M.FEATURES), np.ones(M.FEATURES))
    model.fit(x, first, y, epochs=150)
    assert (((model.forward(x, first, model.p)["y"] > 0.5) == (y > 0.5)).mean()) == 1.0
    e = model.forward(x, first, model.p)["e"]
    assert np.allclose(np.add.reduceat(e, first), 1, atol=1e-5)


def test_passage_features_see_whole_texts():
    x, first = M.passage_features(["a" * 1300, "", None, "B#! " * 200])
    assert list(first) == [0, 3, 4, 5] and len(x) == 7 and not x[3].any()
    assert x[5][7] > 0.2 and np.isfinite(x).all()


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    odd_ids = labels.filter("doc_id % 2 = 1")
    got = X.score(docs, X.train(docs, odd_ids)).join(labels.withColumnRenamed("toxic", "y"), "doc_id")
    n = {(r["y"], r["toxic"]): r["count"] for r in
         got.filter("doc_id % 2 = 0").groupBy("y", "toxic").count().collect()}
    assert n[1, True] > 0.75 * (n[1, True] + n.get((1, False), 0)) and n.get((0, True), 0) < 0.005 * n[0, False]


def test_classifiers_on_odd_inputs(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, 1, 0), (None, 1, 1), (6, None, None), (4, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    odd = odd_docs.withColumn("y", F.lit(1)).withColumn("id", F.lit(2)).withColumn("score", F.lit("x"))
    for labels in (none, some):
        assert M.quality(odd, labels).count() == odd.count()
        assert X.score(odd, X.train(odd, labels)).count() == odd.count()
    kept = X.without_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert M.quality(odd.limit(0), some).count() == 0
    assert X.without_toxic(odd.limit(0), some).count() == 0


# ------------------------------------------------------------------ pipeline

def test_copies_with_blank_lines_leave_no_empty_document(spark, make_docs, words):
    text = " ".join(words(40))
    docs = make_docs([(1, text), (2, text + "\n\n"), (3, f" \n\t\n{text}\n\u00a0\n"), (4, "\n\n")])
    assert {r["doc_id"] for r in corpus_pipeline.repeated_lines(spark, docs, SF).collect()} == {1, 4}


def test_pipeline_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names[0] == "toxicity" and len(names) == 5
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = docs.checkpoint()
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) > 3
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == sizes[-1]
    assert corpus_pipeline.run(spark, SF).exceptAll(last).count() == 0
