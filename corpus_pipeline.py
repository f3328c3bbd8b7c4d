"""A training-data pipeline over the documents table: each stage calls one operator of the llm package.

Every stage takes an empty table and gives one; repeated rows are documents of their own until a stage drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from funnelguard.llm import exact_dedup, packing, quality, secret_scan, simhash
from funnelguard.llm.work import small_batches, stored, workspace


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; null and empty texts are scored as empty ones, and null ids are kept as they are."""
    small_batches(spark)
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts, that of the largest doc_id; null and empty texts are equal, a null doc_id is the smallest."""
    small_batches(spark)
    return exact_dedup.deduplicate(docs)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id; texts without words are one group, null ids all stay."""
    small_batches(spark)
    return simhash.deduplicate(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; null texts stay null."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, placed in sequences of 1024; a null or empty text is its end alone."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", keep_distinct),
    ("SimHash near-dedup", keep_dissimilar),
    ("secret scans", without_secrets),
    ("best-fit packing", pack_sequences),
]

#: The classifier, SimHash and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again by the next."""
    folder = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return docs
