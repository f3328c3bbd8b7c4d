"""Merkle manifest of a dataset (operator 11): a content-addressed DAG and proofs found by descent.

Every row is a leaf, hashed from its fields. The leaves of a group (lang),
in ascending order, are folded in runs of two until one digest is left, the
group's subroot; the subroots, in order of the groups, are folded likewise to
the root. The DAG is stored as records, digest to children, in pages: a page
has the records below one node down to ``levels`` levels, and is found by that
node's digest. As a page spans 2^levels nodes, the number of passes is the
logarithm of the rows to that base, and no pass gathers more than a page.

Proofs are found from the root down. The binary digits of a leaf's rank say
which child to take at each record; the children not taken are collected, and
a page's path segment, reversed, goes before those of the pages above it.
Leaves below one page share the way down to it, which they go as one request.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import id_type, stored, workspace

#: Children of a record, and levels of records in a page.
ARITY, LEVELS = 2, 10
#: Bytes of a digest.
WIDE = 32
#: Rows of a partition of the sorted leaves.
ROWS_EACH = 500_000


def digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()


def parent(children: list[bytes]) -> bytes:
    """H of digests, which stand as lowercase hexadecimal text."""
    return digest("".join(c.hex() for c in children).encode())


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def hashed(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def leaves(docs: DataFrame, id_col: str, group_col: str, fields: list[str], changed: dict[str, Column], tampered: Column) -> DataFrame:
    """doc_id, g, leaf and forged, one row per row of ``docs``; forged is the leaf with fields ``changed`` where ``tampered``, else null.

    g orders and names the group: empty for null, else ``v`` and the group as text.
    """
    group = F.col(f"`{group_col}`").cast("string")
    own = [F.col(f"`{c}`") for c in fields]
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("v"), group)).alias("g"),
        hashed(own).alias("leaf"),
        F.when(tampered, hashed([changed.get(c, col) for c, col in zip(fields, own, strict=True)])).alias("forged"))


def ranked(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``rows`` (with a column g) with rank, their place from 0 among those of their g by ``order``, and n, the rows of their g.

    The rows are range-partitioned and sorted, so that a large group spreads over tasks; only the number of rows of
    each partition and group, a few more than there are partitions and groups, is added up apart.
    """
    count = rows.count()
    sorted_rows = rows.repartitionByRange(max(1, -(-count // ROWS_EACH)), "g", *order).sortWithinPartitions("g", *order)
    # the number holds the partition in its upper bits and the place in it in the lower 33
    placed = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), f"{folder}/sorted")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = stored(placed.groupBy("g", "part").agg(F.count("*").alias("here"), F.min("at").alias("low")), f"{folder}/runs")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("g", "part", "low", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"),
                         F.sum("here").over(Window.partitionBy("g")).alias("n"))
    joined = placed.join(starts, ["g", "part"])
    return joined.withColumn("rank", F.col("start") + F.col("at") - F.col("low")).drop("part", "at", "low", "start")


def levels_of(bottom: list[bytes], levels: int, whole: bool) -> list[list[bytes]]:
    """The nodes of a page level by level from the bottom; a whole group ends at its single top, else all levels are made."""
    made = [bottom]
    while len(made[-1]) > 1 if whole else len(made) <= levels:
        row = made[-1]
        made.append([parent(row[i:i + ARITY]) for i in range(0, len(row), ARITY)])
    return made


def records_of(made: list[list[bytes]]) -> Iterator[tuple[bytes, list[bytes]]]:
    for below, row in zip(made, made[1:]):  # noqa: B905
        for i, d in enumerate(row):
            yield d, below[i * ARITY:(i + 1) * ARITY]


PAGE = "g string, page long, n long, digest binary, depth int, records array<struct<digest:binary,children:array<binary>>>"


def _pages(nodes: DataFrame, levels: int) -> DataFrame:
    """A page for each run of 2^levels nodes (g, rank, digest, n) of a group: its top's digest, its depth and its records."""
    span = ARITY ** levels
    runs = (nodes.groupBy("g", F.floor(F.col("rank") / span).cast("long").alias("page"))
            .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))  # a page at most
            .select("g", "page", "n", F.col("nodes.digest").alias("nodes")))
    kind = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = levels_of(batch.column(3)[i].as_py(), levels, batch.column(2)[i].as_py() <= span)
                found = [{"digest": d, "children": c} for d, c in records_of(made)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, 1) for k in range(3)), pa.array([made[-1][0]], pa.binary()),
                     pa.array([len(made) - 1], pa.int32()), pa.array([found], pa.list_(kind))],
                    ["g", "page", "n", "digest", "depth", "records"])

    return runs.mapInArrow(run, PAGE)


@dataclass(frozen=True)
class Fold:
    """Pages of a fold, the lowest first, and the digest each group folds to (g, digest)."""
    tiers: list[DataFrame]
    tops: DataFrame


def fold(nodes: DataFrame, folder: str, levels: int = LEVELS) -> Fold:
    """Fold nodes (g, rank, digest, n), ranks from 0 without gaps, to one digest for each g; pages are written to ``folder``."""
    span, tiers, tops = ARITY ** levels, [], None
    current, most = nodes, nodes.agg(F.max("n")).first()[0] or 0
    while True:
        pages = stored(_pages(current, levels), f"{folder}/tier-{len(tiers)}")
        tiers.append(pages)
        done = pages.filter(F.col("n") <= span).select("g", "digest")
        tops = done if tops is None else tops.unionByName(done)
        if most <= span:
            return Fold(tiers, tops)
        most = -(-most // span)
        current = pages.filter(F.col("n") > span).select(
            "g", F.col("page").alias("rank"), "digest", F.ceil(F.col("n") / span).cast("long").alias("n"))


def descend(records: dict[bytes, list[bytes]], top: bytes, depth: int, place: int) -> tuple[bytes, list[bytes]]:
    """From ``top`` by the binary digits of ``place``, the highest first: the node reached, and the children not taken, reversed."""
    taken, segment = top, []
    for level in range(depth - 1, -1, -1):
        children = records[taken]
        digit = place // ARITY ** level % ARITY
        segment.append([c for i, c in enumerate(children) if i != digit])
        taken = children[digit]
    # from the leaf up; of one record's children from left to right
    return taken, [c for others in reversed(segment) for c in others]


def _records(column: pa.Array, i: int) -> dict[bytes, list[bytes]]:
    return {r["digest"]: r["children"] for r in column[i].as_py()}


def _down(requests: DataFrame, pages: DataFrame, levels: int) -> DataFrame:
    """The requests (g, page, digest, path) of a tier's pages taken to the nodes below: g, page (their rank), digest and path."""
    span = ARITY ** levels
    # a page is looked up by its digest; its place tells apart pages of the same content
    found = requests.join(pages, ["g", "page", "digest"]).select("g", "page", "digest", "path", "depth", "n", "records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                g, page, top, path, depth, n = (batch.column(k)[i].as_py() for k in range(6))
                records = _records(batch.column(6), i)
                ways = [descend(records, top, depth, k) for k in range(min(span, n - page * span))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(ways)), pa.array([page * span + k for k in range(len(ways))], pa.int64()),
                     pa.array([w[0] for w in ways], pa.binary()), pa.array([b"".join(w[1]) + path for w in ways], pa.binary())],
                    ["g", "page", "digest", "path"])

    return found.mapInArrow(run, "g string, page long, digest binary, path binary")


def requests_at(tops: DataFrame, tree: Fold, folder: str, levels: int, last: int = 0) -> DataFrame:
    """The requests of the pages of tier ``last`` (g, page, digest, path), from the tops (g, digest, path) of their groups down."""
    span = ARITY ** levels
    waiting = None
    for k in range(len(tree.tiers) - 1, last - 1, -1):
        # groups whose top lies in this tier join those that come down from the tier above
        own = tree.tiers[k].filter((F.col("n") <= span) & (F.col("page") == 0)).select("g", "page").join(tops, "g").select(
            "g", "page", "digest", "path")
        waiting = own if waiting is None else waiting.unionByName(own)
        if k > last:
            waiting = stored(_down(waiting, tree.tiers[k], levels), f"{folder}/requests-{k}")
    return waiting


@dataclass(frozen=True)
class Manifest:
    """The stored DAG: ranked leaves, the folds of the groups and of their subroots, and the root (digest; no row of no leaves)."""
    folder: str
    levels: int
    leaves: DataFrame
    groups: Fold
    subroots: DataFrame
    top: Fold
    root: DataFrame


def build(rows: DataFrame, folder: str, levels: int = LEVELS) -> Manifest:
    """The manifest of leaves (doc_id, g, leaf, forged); the leaves of a group ascend by doc_id, equal ones by leaf."""
    placed = ranked(stored(rows, f"{folder}/leaves"), ["doc_id", "leaf", "forged"], f"{folder}/ranks")
    placed = stored(placed, f"{folder}/placed")
    groups = fold(placed.select("g", "rank", F.col("leaf").alias("digest"), "n"), f"{folder}/groups", levels)
    named = groups.tops.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    subroots = stored(ranked(stored(named, f"{folder}/named"), ["name"], f"{folder}/names"), f"{folder}/subroots")
    top = fold(subroots.select("g", "rank", "digest", "n"), f"{folder}/top", levels)
    return Manifest(folder, levels, placed, groups, subroots, top, top.tops.select(F.col("digest").alias("root")))


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, g, leaf, forged, subroot, root and siblings (digests from the leaf to the root, joined), one row per leaf."""
    m = manifest
    tops = m.top.tops.select("g", "digest", F.lit(b"").alias("path"))
    reached = _down(requests_at(tops, m.top, f"{m.folder}/top-down", m.levels), m.top.tiers[0], m.levels)
    # the nodes below the top's lowest pages are the subroots, whose ranks name the groups
    below = stored(reached.withColumnRenamed("page", "rank").join(m.subroots.select("rank", "name"), "rank").select(
        F.col("name").alias("g"), "digest", "path"), f"{m.folder}/subroot-paths")
    asked = requests_at(below, m.groups, f"{m.folder}/groups-down", m.levels)
    span = ARITY ** m.levels
    wanted = m.leaves.groupBy("g", F.floor(F.col("rank") / span).cast("long").alias("page")).agg(
        F.collect_list(F.struct("rank", "doc_id", "leaf", "forged")).alias("rows"))  # a page at most
    subroot = below.select("g", F.col("digest").alias("subroot"))
    # one row for each page and its leaves, so that no key is a hot one
    found = (asked.join(m.groups.tiers[0], ["g", "page", "digest"]).join(wanted, ["g", "page"]).join(subroot, "g")
             .crossJoin(F.broadcast(m.root)).select("g", "digest", "depth", "path", "subroot", "root", "records", "rows"))
    kind = id_type(m.leaves, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                g, top, depth, path, subroot, root = (batch.column(k)[i].as_py() for k in range(6))
                records, rows = _records(batch.column(6), i), batch.column(7).slice(i, 1).flatten()
                rank, ids, leaf, forged = (rows.field(k) for k in range(4))
                found = []
                for at, own in zip(rank.to_pylist(), leaf.to_pylist(), strict=True):
                    reached, segment = descend(records, top, depth, at % span)
                    if reached != own:
                        raise ValueError(f"the manifest has another leaf at rank {at} of group {g!r}")
                    found.append(b"".join(segment) + path)
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([g] * n), leaf, forged, rank, pa.array([subroot] * n, pa.binary()), pa.array([root] * n, pa.binary()),
                     pa.array(found, pa.binary())], ["doc_id", "g", "leaf", "forged", "rank", "subroot", "root", "siblings"])

    return found.mapInArrow(run, f"doc_id {kind}, g string, leaf binary, forged binary, rank long, subroot binary, root binary, "
                                 "siblings binary")


def fold_up(leaf: bytes, siblings: bytes, shape: list[int]) -> bytes:
    """The root that a leaf and its siblings give; ``shape`` has each level's digit, or -1 where the node stands alone."""
    at, node = 0, leaf
    for digit in shape:
        if digit < 0:
            node = parent([node])
        else:
            other = siblings[at:at + WIDE]
            node, at = parent([other, node] if digit else [node, other]), at + WIDE
    return node


def shape_of(rank: int, n: int) -> list[int]:
    """For a leaf at ``rank`` of ``n``: on each level the digit of its node, or -1 where its run has no other node."""
    found = []
    while n > 1:
        found.append(-1 if rank % ARITY == 0 and rank == n - 1 else rank % ARITY)
        rank, n = rank // ARITY, -(-n // ARITY)
    return found


def verify(manifest: Manifest, proved: DataFrame) -> DataFrame:
    """``proved`` with folded_root: the root that the forged leaf, or the leaf where none is forged, gives with the siblings."""
    counts = manifest.leaves.groupBy("g").agg(F.max("n").alias("n"))
    names = manifest.subroots.select(F.col("name").alias("g"), F.col("rank").alias("group_rank"), F.col("n").alias("groups"))
    # a row for each group; Spark broadcasts it where that is small
    rows = proved.join(stored(counts.join(names, "g"), f"{manifest.folder}/shapes"), "g")
    kind = id_type(proved, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, n, group_rank, groups, leaf, forged, siblings = (c.to_pylist() for c in batch.columns[:7])
            folded = [fold_up(f or own, path, shape_of(r, k) + shape_of(gr, gs))
                      for r, k, gr, gs, own, f, path in zip(rank, n, group_rank, groups, leaf, forged, siblings, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array(folded, pa.binary())],
                                             ["leaf", "forged", "siblings", "doc_id", "subroot", "root", "folded"])

    return rows.select("rank", "n", "group_rank", "groups", "leaf", "forged", "siblings", "doc_id", "subroot", "root").mapInArrow(
        run, f"leaf binary, forged binary, siblings binary, doc_id {kind}, subroot binary, root binary, folded binary")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             count_col: str = "n_chars", every: int = 7, levels: int = LEVELS, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (hexadecimal digests).

    A row is tampered with where ``every`` divides the CRC-32 of its doc_id as text: ``count_col`` is one more, nulls stay.
    A null doc_id comes first in its group and is never tampered with; null groups are one group, the first; rows that
    are equal in all fields are leaves of their own, side by side. An empty table has no root and gives no rows.
    """
    folder = folder or workspace(docs.sparkSession, "merkle")
    one_more = (F.col(f"`{count_col}`").cast("decimal(38,0)") + 1).cast("string")
    tampered = F.crc32(F.col(f"`{id_col}`").cast("string")) % every == 0
    built = build(leaves(docs, id_col, group_col, list(fields), {count_col: one_more}, tampered), folder, levels)
    checked = verify(built, proofs(built))
    hex_of = lambda c: F.lower(F.hex(c))
    return checked.select("doc_id", hex_of("leaf").alias("leaf"), hex_of("subroot").alias("subroot"), hex_of("root").alias("root"),
                          F.sha2(hex_of("siblings"), 256).alias("proof_sha256"), hex_of("folded").alias("folded_root"),
                          (F.col("folded") == F.col("root")).alias("verified"))
