"""Byte BPE and token counts against the public libraries, and their own interfaces."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from llm_helpers import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from credspark.llm import byte_bpe as B
from credspark.llm import queries as Q
from credspark.llm import token_counts as T
from credspark.llm.common import Memo, Splitter

ODD = ["", " ", "\n\n  \t", "don't I'LL we've", "ΟΔΥΣΣΕΥΣ Σ Σας İstanbul ﬁ Ångström", "日本語テキスト 🙂🙂👩‍👩‍👧", "a" * 3000,
       "x\x00y z\x85w v u", "<|endoftext|>hi<|startoftext|> there<|endoftext|>", "1234567 12 ²³ ½ Ⅷ",
       "é é ẛ̣", "tab\tand  two   three", "_under_score__ --- ... ###$$$", "ŉ ǅ ǆ ß ẞ",
       "\x1c\x1d\x1e\x1f sep", "word " * 2000, "Ô\U00018d80 \u0558x \ua7d4 \u1c89b", "a\U00016ff4 1"]


@pytest.fixture(scope="module")
def encoder():
    return B.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words_library():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.mark.parametrize("text", ODD)
def test_encoding_equals_the_library(encoder, library, text):
    ids = encoder.encode(text)
    assert ids == library.encode_ordinary(text) and encoder.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(encoder, library, words_library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder.encode(text) == library.encode_ordinary(text)
    counted = T.tokenizer(P.path("word_bpe_49k.json")).count(text)
    assert counted == len(words_library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=30), st.binary(max_size=8), st.integers(0, 30), st.integers(0, 8))
def test_appends_and_edits_equal_encoding_anew(encoder, a, b, new, start, length):
    p = B.Prefixes(encoder.v, a)
    p.append(b)
    assert p.last == B.Prefixes(encoder.v, a + b).last
    start = min(start, len(a + b))
    end = min(start + length, len(a + b))
    p.replace(start, end, new)
    whole = (a + b)[:start] + new + (a + b)[end:]
    assert p.data == whole and p.last == B.Prefixes(encoder.v, whole).last
    assert [encoder.v.bytes[t] for t in p.tokens()] == encoder.v.merge(whole)


def test_an_edit_computes_little(encoder):
    data = (b"the quick brown fox jumps over it " * 200)[:6000]
    p = B.Prefixes(encoder.v, data)
    assert p.replace(1000, 1003, b"xyz") < 400
    assert p.tokens() == B.Prefixes(encoder.v, p.data).tokens()


@pytest.mark.parametrize("text", ODD)
def test_counts_equal_the_library(words_library, text):
    want = len(words_library.encode(text, add_special_tokens=False).ids)
    assert T.tokenizer(P.path("word_bpe_49k.json")).count(text) == want


def test_merges_by_heap():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("a", "a"): 3}
    assert T.merges_of(list("abc"), ranks) == 2 and T.merges_of(list("aaaa"), ranks) == 2
    assert T.merges_of(["x"], ranks) == 0 and T.merges_of(list("ab" * 50_000), ranks) > 50_000 - 2


def test_query_digests(spark, library):
    got = {r["doc_id"]: r for r in Q.op7_byte_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_query_counts(spark, words_library):
    got = {r["doc_id"]: r for r in Q.op8_token_counts(spark, SF_SMALL).collect()}
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        n = len(words_library.encode(d["text"] or "", add_special_tokens=False).ids)
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((d["text"] or "").encode()), n > 2048)


def test_odd_rows(odd_docs):
    path = P.path("byte_bpe_50k.tiktoken")
    e = B.encode(odd_docs, path, P.PATTERN)
    for r in e.join(odd_docs.dropDuplicates(["doc_id"]), "doc_id").filter("doc_id <> 4").collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    counts = T.token_counts(odd_docs, P.path("word_bpe_49k.json"))
    assert counts.count() == e.count() == odd_docs.count()
    assert counts.filter("doc_id = 1").first()["n_tokens"] == 0
    assert B.encode_digests(odd_docs.limit(0), path, P.PATTERN).count() == 0
    assert T.token_counts(odd_docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_memo_keeps_what_is_used():
    asked = []
    memo = Memo(lambda k: asked.append(k) or k * 2, 3)
    for k in (1, 2, 3, 4, 1, 5, 1, 6, 7, 1):
        assert memo[k] == 2 * k
    assert asked.count(1) == 1 and len(memo) <= 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab' ſÀéſ×÷ǅɐ²1_-\t\n\x1c\x85 İ", max_size=20))
def test_fast_split_equals_the_slow_one(text):
    s = Splitter(P.PATTERN)
    assert s(text) == s.any(text)
