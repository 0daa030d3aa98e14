"""Registered queries of this package: one for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credspark.llm.byte_bpe import encode_digests
from credspark.llm.common import table
from credspark.llm.decontaminate import overlaps
from credspark.llm.line_dedup import line_dedup
from credspark.llm.lm_scoring import lm_scores
from credspark.llm.near_duplicates import links
from credspark.llm.periodic_runs import periodic_runs
from credspark.llm.quality_mil import quality
from credspark.llm.quality_rules import quality_rules
from credspark.llm.sharding import shard_documents
from credspark.llm.token_counts import token_counts
from credspark.llm.toxicity import score, train
from credspark.llm.url_filter import url_filter
from credspark.llm.whitening import whiten

#: Listed entries of op10: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    """Every (document, benchmark item) with a verified overlap: doc_id, item_id, item_words, best, hits."""
    return overlaps(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("th")


def op2_sharding(spark: SparkSession, d: str) -> DataFrame:
    return shard_documents(table(spark, d, "documents"))


def op3_quality_mil(spark: SparkSession, d: str) -> DataFrame:
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(table(spark, d, "documents"))


def op5_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its class id and links: doc_id, class_id, n_links, n_text_links, group_size."""
    return links(table(spark, d, "documents"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the probabilities of the chain's categories and the verdict ``toxic``."""
    docs = table(spark, d, "documents")
    return score(docs, train(docs, table(spark, d, "labels")))


def op7_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    return encode_digests(table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern())


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(table(spark, d, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text without repeated blocks, and the positions of the deleted lines: doc_id, text, gone."""
    return line_dedup(table(spark, d, "documents").select("doc_id", "text"), gone_as="gone")


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, d, "pages"), rules)


def op11_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its base score and the attention model's score."""
    return lm_scores(table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    """Every usable vector's 32 leading whitened components."""
    return whiten(table(spark, d, "embeddings"))


def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every document's periodic runs and the digest of its text without repeated blocks."""
    return periodic_runs(table(spark, d, "documents"))


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sharding": op2_sharding,
    "op3_quality_mil": op3_quality_mil,
    "op4_quality_rules": op4_quality_rules,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_lm_scores": op11_lm_scores,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

S: dict[str, str] = {}

S["op10_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM cut),
parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path
  FROM hosts),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
