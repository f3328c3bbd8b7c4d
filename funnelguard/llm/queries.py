"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, centroids, exact_dedup, fingerprints, kneser_ney, line_dedup, merkle, minhash, oracle, packing, quality, secret_scan, simhash,
               suffix_dedup)
from .work import documents, small_batches


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf_dir))


def kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, numbered = kneser_ney.train_numbered(documents(spark, sf_dir))
    return kneser_ney.score_numbered(numbered, model)


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.classify(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.with_next(documents(spark, sf_dir))
    return found.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
                        fingerprints.digest(F.col("found")).alias("fingerprint"),
                        fingerprints.digest(F.col("edited_found")).alias("edited_fingerprint"), "near_edited", "near_next")


def line_dedup_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_markov", F.sha2("base", 256).alias("base_sha256"), "spans")


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.deduplicate_strings(documents(spark, sf_dir)))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return centroids.report(*centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


QUERIES = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_exact_dedup": exact,
    "op3_kneser_ney": kneser_ney_scores,
    "op4_byte_bpe": byte_level_bpe,
    "op5_quality_classifier": quality_classifier,
    "op6_document_fingerprints": document_fingerprints,
    "op7_line_dedup": line_dedup_bitmaps,
    "op8_simhash_near_dedup": simhash_near_dedup,
    "op9_secret_scans": secret_scans,
    "op10_suffix_array_dedup": suffix_array_dedup,
    "op11_merkle_manifest": merkle_manifest,
    "op12_minhash_near_dedup": minhash_near_dedup,
    "op13_centroid_clustering": centroid_clustering,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = oracle.ORACLE_SQL | {
    "op2_exact_dedup": f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op7_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                                          '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, first_doc IS NOT NULL AND k.doc_id <> first_doc AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}
