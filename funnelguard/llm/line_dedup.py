"""Line dedup over hashes of lines (operator 7), in DataFrame functions only.

Only hashes of lines, with document and position, are shuffled. The few lines that make
up a large share of all lines are found by an exact count (map-side
combined) and decided where they lie; the others are range-partitioned by
hash, sorted by document and position within, and the first document of each
hash streams over its rows. What comes back per document is a bitmap of the
lines it keeps, in 64-line words of which all-kept ones are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import id_and_text, parts, stored, workspace

MIN_CHARS = 10
#: A line hash with more than 1 / FREQUENT of all rows is decided by broadcast; there are fewer than FREQUENT of them.
FREQUENT = 256
#: Rows of hashes a range partition takes.
ROWS_PER_TASK = 500_000
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version (hash of the text, for rows that share a doc_id), pos and a 128-bit hash of each line's key."""
    texts = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("version"), F.translate("text", UPPER, LOWER).alias("text"))
    lines = texts.select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "version", "pos", F.btrim("line", F.lit(SPACE)).alias("key"))
    return keys.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def dropped_lines(hashes: DataFrame, rows: int, frequent: int = FREQUENT, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """doc_id, version, pos of every line whose key is in a document of smaller doc_id (a null doc_id is the smallest)."""
    # fewer than `frequent` rows, as each holds more than 1 / `frequent` of all
    heavy = (hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id")).alias("first"))
             .filter(F.col("n") * frequent > rows).select("h1", "h2", "first"))
    marked = hashes.join(F.broadcast(heavy), ["h1", "h2"], "left")
    known = marked.filter("first IS NOT NULL")
    rest = marked.filter("first IS NULL").select("h1", "h2", "doc_id", "version", "pos")
    seen = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = (rest.repartitionByRange(parts(rows, per_task), "h1", "h2").sortWithinPartitions("h1", "h2", "doc_id", "pos")
                .withColumn("first", F.first(F.struct("doc_id")).over(seen)))
    return (known.select(*streamed.columns).unionByName(streamed)
            .filter(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select("doc_id", "version", "pos"))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """doc_id, version, keep: for each word of 64 lines with a dropped one, a bit for each line that stays."""
    words = dropped.groupBy("doc_id", "version", F.shiftright("pos", 6).alias("word")).agg(
        F.expr("~bit_or(shiftleft(1L, pos & 63))").alias("bits"))
    return words.groupBy("doc_id", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined by line feeds; without a bitmap the whole text."""
    def stays(_: Column, i: Column) -> Column:
        word = F.try_element_at(keep, F.shiftright(i, 6))
        return word.isNull() | (F.getbit(word, i.bitwiseAND(F.lit(63))) == 1)

    return F.when(keep.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))


def find_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                 frequent: int = FREQUENT, per_task: int = ROWS_PER_TASK, folder: str | None = None) -> DataFrame:
    """The keep bitmaps of the documents that lose lines."""
    folder = folder or workspace(docs.sparkSession, "line-dedup")
    hashes = stored(line_hashes(docs, min_chars, id_col, text_col), f"{folder}/hashes")
    return stored(keep_bitmaps(dropped_lines(hashes, hashes.count(), frequent, per_task)), f"{folder}/bitmaps")


def deduplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                      **limits) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that stays), one row per row of ``docs``.

    A null or empty text is one empty line. Rows that share a doc_id are one document: none of its lines is
    dropped for another of its rows. A null doc_id counts as the smallest. An empty table gives no rows.
    """
    keep = find_bitmaps(docs, min_chars, id_col, text_col, **limits).select(
        F.col("doc_id").alias("keep_id"), F.col("version").alias("keep_version"), "keep")
    texts = id_and_text(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    joined = texts.join(keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("version") == F.col("keep_version")), "left")
    lost = F.aggregate(F.map_values("keep"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(F.bitwise_not(bits)))
    return joined.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
                         F.coalesce(lost, F.lit(0).cast("long")).alias("n_dropped"),
                         kept_text(F.col("text"), F.col("keep")).alias("kept"))
