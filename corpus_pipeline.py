"""A corpus pipeline: five stages over ``documents``, each written and read again by the next.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame.  All but the last return the columns they were given.
A stage leaves clean documents as they are; null texts pass every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credspark.llm.byte_bpe import encode_digests
from credspark.llm.common import table
from credspark.llm.decontaminate import decontaminate
from credspark.llm.line_dedup import line_dedup
from credspark.llm.near_duplicates import one_of_each
from credspark.llm.queries import tokenizer_path, tokenizer_pattern
from credspark.llm.toxicity import without_toxic
from credspark.session import scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labels, does not take for toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier document has; one that loses all its text goes."""
    out = line_dedup(docs, gone_as="_llm_gone")
    emptied = (F.size("_llm_gone") > 0) & ~F.col("text").rlike(r"(?U)[^\s\x1c-\x1f]")
    return out.filter(~F.coalesce(emptied, F.lit(False))).drop("_llm_gone")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, and every document alone."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of each text's ids and of the bytes decoded from them."""
    return encode_digests(docs, tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern())


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Trained and aligned stages have no SQL twin; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, "pipeline")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
