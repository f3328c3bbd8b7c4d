"""SimHash near-dedup with pivot distance tables (operator 8).

Distinct fingerprints are compared, never their copies. Two fingerprints
that differ in at most t bits agree on one of any t + 1 disjoint groups of
bits, so each goes to t + 1 blocks; a block that is too large is split again
by t + 1 groups of its remaining bits, as often as needed, which loses no
pair. In a block, the Hamming distances to the reference fingerprints are
the coordinates of a row: rows are put in order of the first coordinate,
pairs whose coordinates differ by more than t anywhere are discarded (the
triangle inequality), and the survivors are verified. A block returns a
spanning forest of its links, not the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import stars
from .work import id_and_text, id_type, parts, stored, workspace

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Reference fingerprints, rows of a block before it is split, splits at most (by then few bits remain), rows handled at once.
PIVOTS, BLOCK_ROWS, MAX_SPLITS, SLAB_ROWS = 24, 4096, 7, 200_000
#: Shingles whose bits are counted at once.
COUNT_ROWS = 1 << 16


def fingerprint(raw: bytes, words_each: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text in UTF-8; A-Z count as a-z, and a text without words has fingerprint 0."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()  # of bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_each:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [xxh64_intdigest(joined[a:b], SEED)
                  for a, b in zip(starts[: 1 - words_each].tolist() if words_each > 1 else starts.tolist(),
                                  ends[words_each - 1:].tolist(), strict=True)]
    set_in = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        some = np.array(hashes[i: i + COUNT_ROWS], "<u8")
        set_in += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id and its fingerprint as a signed long."""
    kind = id_type(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words_each) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, fp long")


@lru_cache(maxsize=100_000)
def known_bits(path: int, ways: int) -> int:
    """The bits that all rows of a block agree on. A path's digits, base ``ways`` + 1, name the group (from 1) of each split."""
    if not path:
        return 0
    before = known_bits(path // (ways + 1), ways)
    free = [b for b in range(64) if not before >> b & 1]
    group = path % (ways + 1) - 1
    a, b = len(free) * group // ways, len(free) * (group + 1) // ways
    return before | sum(1 << x for x in free[a:b])


def split_blocks(rows: DataFrame, ways: int) -> DataFrame:
    """path, value, fp: each row's ``ways`` blocks below its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for way in range(1, ways + 1):
                below = path * (ways + 1) + way
                kinds, which = np.unique(below, return_inverse=True)
                bits = np.array([known_bits(int(k), ways) for k in kinds], np.uint64).view(np.int64)
                value = fp & bits[which] if len(kinds) else fp
                yield pa.RecordBatch.from_arrays([pa.array(below), pa.array(value), batch.column(1)], ["path", "value", "fp"])

    return rows.select("path", "fp").mapInArrow(run, "path long, value long, fp long")


def blocks(classes: DataFrame, max_bits: int, block_rows: int, folder: str) -> DataFrame:
    """path, value, fp: blocks of at most ``block_rows`` rows, unless nearly all bits of a block are known."""
    ways, done = max_bits + 1, None
    current = classes.select(F.lit(0).cast("long").alias("path"), "fp")
    for k in range(MAX_SPLITS):
        split = stored(split_blocks(current, ways), f"{folder}/split-{k}")
        large = stored(split.groupBy("path", "value").count().filter(F.col("count") > block_rows).select("path", "value"),
                       f"{folder}/large-{k}")
        if large.isEmpty() or k == MAX_SPLITS - 1:
            return split if done is None else done.unionByName(split)
        small = split.join(large, ["path", "value"], "left_anti").select("path", "value", "fp")
        done = small if done is None else done.unionByName(small)
        current = split.join(large, ["path", "value"], "left_semi").select("path", "fp")
    return done


def pivots(count: int) -> np.ndarray:
    return np.random.default_rng(64).integers(0, 2 ** 64, count, dtype=np.uint64, endpoint=False)


class _Forest:
    """Roots of rows under links, many links at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        r = self.up[rows]
        while True:
            rr = self.up[r]
            if np.array_equal(rr, r):
                self.up[rows] = r
                return r
            r = rr

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


def linked(block: np.ndarray, fp: np.ndarray, max_bits: int, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints that span the links within each block; ``block`` has equal numbers for a block's rows."""
    table = np.bitwise_count(fp[:, None] ^ references[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], block))
    block, fp, table = block[order], fp[order], table[order]
    forest, left, step = _Forest(len(fp)), np.arange(len(fp)), 0
    while True:
        step += 1
        left = left[left + step < len(fp)]
        # rows of a block are in order of the first coordinate: past the bound no later row is nearer
        left = left[(block[left] == block[left + step]) & (table[left + step, 0] - table[left, 0] <= max_bits)]
        if not len(left):
            break
        pair = left
        for p in range(1, table.shape[1]):
            pair = pair[np.abs(table[pair, p] - table[pair + step, p]) <= max_bits]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= max_bits]
        forest.link(pair, pair + step)
    rows = np.arange(len(fp))
    root = forest.roots(rows)
    other = root != rows
    return fp[other], fp[root[other]]


def links(blocked: DataFrame, rows: int, max_bits: int, references: int = PIVOTS) -> DataFrame:
    """a, b: fingerprints that differ in at most ``max_bits`` bits, enough of them to connect all that do in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, held, count = pivots(references), [], 0

        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            path, value, fp = columns
            starts = np.r_[True, (path[1:] != path[:-1]) | (value[1:] != value[:-1])] if len(fp) else np.zeros(0, bool)
            a, b = linked(np.cumsum(starts), fp.view(np.uint64), max_bits, refs)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append([np.asarray(c) for c in batch.columns])
            count += batch.num_rows
            if count >= SLAB_ROWS:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
                whole = int(np.argmax(same))  # the last block may go on in the next batch
                if whole:
                    yield found([c[:whole] for c in columns])
                held, count = [[c[whole:] for c in columns]], len(same) - whole
        if held:
            yield found([np.concatenate(c) for c in zip(*held, strict=True)])

    return (blocked.repartition(parts(rows, SLAB_ROWS), "path", "value").sortWithinPartitions("path", "value")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text", block_rows: int = BLOCK_ROWS, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), component_id, the smallest doc_id reachable over links.

    Fingerprints link at ``max_bits`` or fewer differing bits; equal ones always do, also the zero of texts
    without words (null, empty, white space). Null doc_ids are passed over in the smallest; a component of
    null ids alone has a null component_id. Repeated rows stay. An empty table gives no rows.
    """
    folder = folder or workspace(docs.sparkSession, "simhash")
    table = stored(fingerprints(docs, words_each, id_col, text_col), f"{folder}/fingerprints")
    classes = stored(table.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{folder}/classes")
    blocked = stored(blocks(classes, max_bits, block_rows, folder), f"{folder}/blocks")
    star = stars(links(blocked, blocked.count(), max_bits), f"{folder}/stars")
    rooted = stored(classes.join(star, F.col("fp") == F.col("u"), "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")), f"{folder}/rooted")
    # kept apart, so that both sides of the join are shuffles, in which adaptive execution splits a large component
    lowest = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), f"{folder}/lowest")
    labels = stored(rooted.join(lowest, "root").select("fp", "component_id"), f"{folder}/labels")
    return table.join(labels, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: that of its smallest doc_id.

    Rows that share a doc_id are one document, of which one row stays; rows without a doc_id all stay.
    """
    found = near_duplicates(docs, words_each, max_bits, id_col, text_col)
    stay = found.filter("doc_id = component_id").select(F.col("doc_id").alias("stay_id")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(f"`{id_col}`").alias("id"))
    named = rows.join(stay, F.col("id") == F.col("stay_id"), "left_semi")
    numbered = named.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id"))).filter("n = 1")
    return numbered.select("doc.*").unionByName(rows.filter("id IS NULL").select("doc.*"))


def hex_digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
