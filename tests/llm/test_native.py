"""Decontamination, quality rules and URL filters against brute force and on odd inputs."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from credspark.llm import decontaminate as D
from credspark.llm import queries as Q
from credspark.llm import quality_rules as R
from credspark.llm import url_filter as U
from llm_helpers import SF_SMALL, no_python


def brute_overlaps(docs, items):
    unspaced = re.compile("([\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e7f])")
    split = lambda t: [w for w in re.split(r"[^\w]+|_", unspaced.sub(r" \1 ", (t or "").lower())) if w]
    out = set()
    for i, t in docs:
        a = split(t)
        for k, u in items:
            b = split(u)
            width = min(D.WINDOW, len(b))
            if not a or not b:
                continue
            if len(b) < D.WINDOW:       # the whole item, one word of 8 to 12 may differ
                need = len(b) - (len(b) >= D.LOOSE_FROM)
                if any(sum(x == y for x, y in zip(a[j:j + len(b)], b)) >= need for j in range(len(a) - len(b) + 1)):
                    out.add((i, k))
                continue
            need = -(-width * 8 // 10)
            for shift in range(-len(b), len(a)):
                eq = [0 <= j + shift < len(a) and a[j + shift] == b[j] for j in range(len(b))]
                if any(sum(eq[s: s + width]) >= need for s in range(len(b) - width + 1)):
                    out.add((i, k))
                    break
    return out


@pytest.fixture(scope="module")
def leaks(words):
    items = [(k, " ".join(words(n))) for k, n in enumerate((40, 13, 25, 9, 5, 60))] + [(6, None), (7, ""), (0, None)]
    items += [(20, "敏捷的棕色狐狸跳过了那只懒狗,然后回家睡觉去了今天天气好"), (21, " ".join(words(12))), (22, " ".join(words(8))),
              (23, words(1)[0] + "x"), (24, "我们 agree"), (25, "สวัสดีชาวโลกทุกคน")]
    docs = []
    for i in range(40):
        body = words(80)
        k = i % 8
        if items[k][1]:
            passage = items[k][1].split()
            for s in range(i // 8):             # up to four substitutions
                passage[(5 * s + i) % len(passage)] = "other"
            start = i % max(1, len(passage) // 2)
            body[20:20] = passage[start:]
        docs.append((i, " ".join(body).capitalize().replace(" ", ", ", 3)))
    zh, short = items[-6][1], {k: t for k, t in items if k in (21, 22)}
    docs += [(100, f"前言{zh}结尾"), (101, zh.replace("狐", "猫")), (102, zh[:10]), (103, "今天我们agree了"), (104, "ภาษา" + items[-1][1])]
    for k, t in short.items():
        for cut in range(3):        # so many words differ
            w = t.split()
            w[1:1 + cut] = ["other"] * cut
            docs.append((k * 10 + cut, " ".join([*words(5), *w, *words(5)])))
    docs += [(400, items[-3 - 0][1] + " " + items[-4 + 1][1]), (401, items[8][1] or ""), (402, "a " + items[-3][1] + " b")]
    return docs, items


def test_overlaps_equal_brute_force(spark, make_docs, leaks):
    docs, items = leaks
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.overlaps(make_docs(docs), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute_overlaps(docs, items)
    kept = {r["doc_id"] for r in D.decontaminate(make_docs(docs), bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in brute_overlaps(docs, items)}


def test_overlaps_in_blocks(spark, make_docs, leaks, monkeypatch):
    docs, items = leaks
    monkeypatch.setattr(D, "BLOCK_BYTES", 20_000)
    got = D.overlaps(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute_overlaps(docs, items)


def test_decontaminate_odd_inputs(spark, odd_docs):
    bench = spark.createDataFrame([(1, "One two three, four five six seven eight."), (None, None)],
                                  "item_id long, text string")
    odd = odd_docs.withColumn("h", F.lit(1)).withColumn("k_id", F.lit(2)).withColumn("seed", F.lit(3))
    out = D.decontaminate(odd, bench)
    assert out.columns == odd.columns
    assert out.count() == odd.count()           # a short item must be there in whole
    odd = odd.withColumn("text", F.when(F.col("text").startswith("one"), F.concat("text", F.lit(" eight")))
                         .otherwise(F.col("text")))
    out = D.decontaminate(odd, bench)
    assert out.count() == odd.count() - 3       # both rows of id 4 with that text, and id 6
    assert D.decontaminate(odd, bench.limit(0)).count() == odd.count()
    assert D.overlaps(odd.limit(0), bench).count() == 0


def test_decontaminate_keeps_document_text_out_of_the_shuffle(spark):
    plan = Q.op1_decontaminate(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and no_python(plan)


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
    often = Counter(wins)
    covered = {j for i, x in enumerate(wins) if often[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def test_quality_counts_equal_brute_force(spark, make_docs, words):
    docs = [(i, r["text"]) for i, r in enumerate(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())]
    docs += [(1000, None), (1001, ""), (1002, "a a a a a"), (1003, "x y z\nx y z\n \nx y z q"), (1004, "\n\n"),
             (1005, "a\x0bb\x0cc\rd é\u00a0ö #"), (1006, " ".join(["ab cd ef"] * 30_000)), (1007, "one two"),
             (None, "é " * 60)]
    got = {r["doc_id"]: r for r in R.quality_rules(make_docs(docs)).collect()}
    for i, t in docs:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute_counts(t), (i, t and t[:60])
        assert not (r["base_failed"] and r["kept"])


def test_quality_rules_separate_junk(spark):
    got = Q.op4_quality_rules(spark, SF_SMALL.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    rows = got.join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    n = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in rows}
    assert n.get((0, False, True), 0) == 0 and n[1, False, True] > 20 * n.get((1, False, False), 0)


def test_em_learns_accuracies():
    import random

    draw = random.Random(3)
    counts = Counter()
    for _ in range(4000):
        good = draw.random() < 0.8
        votes = []
        for acc, speaks in ((0.95, 0.9), (0.9, 0.7), (0.6, 0.9)):
            right = draw.random() < acc
            votes.append(0 if draw.random() > speaks else (1 if good == right else -1))
        counts[tuple(votes)] += 1
    tables, prior = R.fit(sorted(counts.items()))
    assert prior > 0 and tables[0][1] > tables[2][1] > 0 > tables[2][-1] > tables[0][-1]
    assert R.fit([]) == ([], 0.0)


def test_quality_rules_odd_inputs(odd_docs):
    assert R.quality_rules(odd_docs.limit(0)).count() == 0
    got = R.quality_rules(odd_docs.withColumn("wh", F.lit(1)).withColumn("low", F.lit(1)))
    assert got.count() == odd_docs.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert no_python(plan)


URLS = ["http://a.net/x", "https://Example.NET/en/1", "http://example.net/en", "http://www.example.net/en/?q#f",
        "http://example.net", "http://example.net?x=/en/", "http://myexample.com/de/1", "http://example.com/de/",
        "http://x.org/fr/1", "http://org/fr/", "http://x.org/fr", "http://net/", "no scheme.net/x", "", None,
        "http:///path", "ftp://a.b.example.com/de/#x", "http://é.net/\n/x", "http://net./x", "http://.net/x",
        "http://u@x.net:80/en/", "http://example.net/EN/", "a://b://c.net/x"]


def brute_verdict(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in listed
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_filter_equals_brute_force(spark):
    pages = spark.createDataFrame([*enumerate(URLS), (3, URLS[3]), (None, URLS[0])], "page_id long, url string")
    rules = spark.createDataFrame(Q.URL_RULES, "host string, path string, verdict string")
    got = U.url_filter(pages.withColumn("host", F.lit("clash")).withColumn("block", F.lit(1)), rules).collect()
    want = [(i, *brute_verdict(u, Q.URL_RULES)) for i, u in [*enumerate(URLS), (3, URLS[3]), (None, URLS[0])]]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_url_filter_long_lists_and_empty_ones(spark):
    listed = [(f"h{i}.net", f"/p{i % 3}/", "block") for i in range(3000)] + [("h1.net", "/p1/", "allow")]
    pages = spark.createDataFrame([(i, f"http://www.h{i}.net/p{i % 4}/x") for i in range(4000)],
                                  "page_id long, url string")
    schema = "host string, path string, verdict string"
    got = {r["page_id"]: r["verdict"] for r in U.url_filter(pages, spark.createDataFrame(listed, schema)).collect()}
    assert got == {i: "block" if i < 3000 and i % 4 == i % 3 else "allow" for i in range(4000)}
    assert U.url_filter(pages, spark.createDataFrame([], schema)).filter("verdict = 'allow'").count() == 4000
    assert U.url_filter(pages.limit(0), spark.createDataFrame(listed, schema)).count() == 0


def test_bloom_filter_passes_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"))
    others = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("host"), F.lit("/").alias("path"))
    assert U.maybe_listed(keys, keys, 5000).count() == 5000
    assert U.maybe_listed(others, keys, 5000).count() < 200
