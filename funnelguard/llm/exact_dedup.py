"""Exact dedup with a heavy-hitter split (operator 2).

Texts are equal when identical after lower-casing A-Z. Their digests are
computed once and stored. Misra-Gries summaries of the tasks, added up, give
the few digests that may be frequent; one exact count verifies them, and the
verified ones are broadcast, so their rows are decided where they lie.
All other digests, none of them frequent, go through an ordinary shuffle.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import id_and_text, id_type, stored, workspace

#: Counters of a Misra-Gries summary: every digest of more than 2 / (COUNTERS + 1) of the rows is found.
COUNTERS = 255


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the SHA-256 (32 bytes) of the text with A-Z lower-cased; a null text counts as empty."""
    kind = id_type(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() changes A-Z only
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = [hashlib.sha256(t.lower()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, digest binary")


def merged(kept: Counter, counters: int) -> Counter:
    """A Misra-Gries summary cut back to ``counters`` items: the next largest count is taken from all."""
    if len(kept) <= counters:
        return kept
    cut = sorted(kept.values(), reverse=True)[counters]
    return Counter({k: n - cut for k, n in kept.items() if n > cut})


def frequent_digests(table: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """Every digest of more than 2 / (counters + 1) of the rows, and a few others.

    A task's summary misses at most its rows / (counters + 1) of a digest, so the sums over tasks miss at
    most ``rows`` / (counters + 1); as the sums add up to ``rows`` at most, no more than ``counters`` + 1
    digests pass that bound, whatever the size of the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            # equal digests of a batch count at once; summaries of batches merge with the same bound
            kept = merged(kept + Counter(batch.column(0).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], ["digest", "low"])

    least = rows / (counters + 1)
    return (table.select("digest").mapInArrow(run, "digest binary, low long")
            .groupBy("digest").agg(F.sum("low").alias("low")).filter(F.col("low") >= F.lit(least)).select("digest"))


def winners(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The verified frequent digests with their last row (doc_id, row) and group size: counters + 1 rows at most."""
    rows = table.count()
    candidates = frequent_digests(table, rows, counters)
    # at most counters + 1 rows of 32 bytes by the bound above
    counted = (table.join(F.broadcast(candidates), "digest", "left_semi")
               .groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size")))
    return counted.filter(F.col("group_size") * (counters + 1) > rows)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS,
           folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays (a null doc_id is below all others). Of rows that
    also share that doc_id exactly one stays. Null and empty texts are equal; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or workspace(spark, "exact-dedup")
    # the row number is stored with the digest, so that it cannot change when a task runs again
    table = stored(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()),
                   f"{folder}/digests")
    heavy = stored(winners(table, counters), f"{folder}/winners")

    marked = table.join(F.broadcast(heavy), "digest", "left")
    decided = marked.filter("group_size IS NOT NULL")
    rest = marked.filter("group_size IS NULL").select("digest", "doc_id", "row")
    groups = rest.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size"))
    rest = rest.join(groups, "digest")
    both = decided.select(*rest.columns).unionByName(rest)
    return both.select("doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
                       (F.col("row") == F.col("last.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; of repeated rows one."""
    from pyspark.sql import Window

    key = F.sha2(F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                             "abcdefghijklmnopqrstuvwxyz"), 256)
    stay = decide(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("stay_id"),
                                                               F.col("text_sha256").alias("stay_key"))
    # the row as one struct, so that its columns cannot clash with those made here
    rows = docs.select(F.struct("*").alias("doc"), F.col(f"`{id_col}`").alias("id"), key.alias("key"))
    joined = rows.join(stay, (F.col("key") == F.col("stay_key")) & F.col("id").eqNullSafe(F.col("stay_id")))
    numbered = joined.withColumn("n", F.row_number().over(Window.partitionBy("key", "id").orderBy("key")))
    return numbered.filter("n = 1").select("doc.*")
