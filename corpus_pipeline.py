"""Corpus pipeline: from raw ``documents`` to token ids for training.

Five stages, each one operator of :mod:`ledgerlake.llm`.  A stage takes
(spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next one's ``docs``; all but the last return the columns of
``documents``.

1. quality      documents that the classifier rejects go
2. near_copies  of each group of near copies the document with the smallest id stays
3. benchmark    documents with a passage of a benchmark item go
4. secrets      secrets are replaced by a mark, ``n_chars`` is counted again
5. tokens       token ids: doc_id, token_ids, n_tokens, exact

Empty tables, null and empty texts and extra columns pass as the operators say:
a null or empty text is scored as any other, is no copy, holds no passage and no
secret; a null text has null token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontamination, ngram_join, quality, secret_scan, sentencepiece_codec
from ledgerlake.llm.common import ship, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    masked = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return sentencepiece_codec.encode(docs, sentencepiece_codec.load(), check=True)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]

#: SQL can express neither a fitted classifier nor a tokenizer's search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
