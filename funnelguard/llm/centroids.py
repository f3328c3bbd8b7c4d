"""Centroid clustering by dimension-sharded Lloyd rounds (operator 13), in exact integers.

Vectors are stored as slices: of each chunk of vectors one row for each block
of columns. A round works out, for each slice, the squared distances to the
centroids over its own columns alone, from the slice of the centroids that
belongs to the block. The blocks of a chunk are added up, the nearest
centroid of each vector goes back to every block of its chunk, and each block
adds up its own columns by cluster and so makes its own slice of the next
centroids. No task sees all columns, and nothing but the number of vectors is
fetched by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import id_type, stored, workspace

CLUSTERS, ROUNDS, SCALE, SEED_TEXT = 8, 10, 1024, "3:"
#: Components of a vector, columns of a block, and vectors of a chunk at most.
COMPONENTS, BLOCK, CHUNK_ROWS = 64, 16, 4096


@dataclass(frozen=True)
class Shards:
    """Where the slices lie, and their measures."""
    slices: DataFrame
    ids: DataFrame
    vectors: int
    blocks: int


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id and values (doubles) of the vectors with exactly ``components`` components, none null, NaN or infinite."""
    values = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.filter((F.size(values) == components) & whole).select(F.col(f"`{id_col}`").alias("vec_id"), values.alias("values"))


def sliced(vectors: DataFrame, folder: str, components: int = COMPONENTS, block: int = BLOCK, scale: int = SCALE,
           chunk_rows: int = CHUNK_ROWS) -> Shards:
    """The vectors of :func:`kept_vectors` as integers floor(``scale`` * x), cut into chunks of rows and blocks of columns."""
    spark = vectors.sparkSession
    kind = id_type(vectors, "vec_id")
    edges = list(range(0, components, block))
    # sums of squares over all components, and over a chunk's rows, have to hold in 64 bits
    largest = int((2.0 ** 62 / components) ** 0.5 / 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                some = batch.slice(at, chunk_rows)
                flat = some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
                whole = np.floor(flat * float(scale))
                if len(whole) and np.abs(whole).max() > largest:
                    raise ValueError(f"a component times {scale} is beyond {largest}, where squared distances no longer fit 64 bits")
                cells = whole.astype(np.int64)
                # the number of a chunk's first row names it; ids go with the first block
                chunk = some.column(0)[0].as_py()
                blobs = [np.ascontiguousarray(cells[:, a:a + block]).astype("<i8").tobytes() for a in edges]
                ids = pa.array([some.column(1).to_pylist()] + [None] * (len(edges) - 1), pa.list_(some.column(1).type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(edges), pa.int64()), pa.array(range(len(edges)), pa.int32()), pa.array(blobs, pa.binary()), ids],
                    ["chunk", "block", "cells", "ids"])

    # row numbers are stored before chunks are named after them
    numbered = stored(vectors.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "values"), f"{folder}/vectors")
    cut = stored(numbered.mapInArrow(run, f"chunk long, block int, cells binary, ids array<{kind}>"), f"{folder}/slices")
    return Shards(cut.select("chunk", "block", "cells"), cut.filter("block = 0").select("chunk", "ids"), numbered.count(), len(edges))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, scale: int = SCALE, block: int = BLOCK, text: str = SEED_TEXT) -> DataFrame:
    """block, cluster, dim, value: the vectors with the smallest SHA-256 of ``text`` and their id, in that order.

    Null ids come last; rows of one id follow their components. There are fewer centroids than ``clusters``
    where there are fewer vectors.
    """
    hashed = vectors.select(F.sha2(F.concat(F.lit(text), F.col("vec_id").cast("string")), 256).alias("h"), "values")
    # a bounded number of rows: each task keeps its own least ones
    chosen = hashed.orderBy(F.col("h").asc_nulls_last(), "values").limit(clusters)
    numbered = chosen.agg(F.array_sort(F.collect_list(F.struct(F.coalesce("h", F.lit("~")).alias("h"), "values"))).alias("all"))
    rows = numbered.select(F.posexplode("all").alias("cluster", "one")).select("cluster", F.posexplode("one.values").alias("dim", "x"))
    return rows.select(F.floor(F.col("dim") / block).cast("int").alias("block"), "cluster", "dim",
                       F.floor(F.col("x") * float(scale)).cast("long").alias("value"))


def _slices_of(centroids: DataFrame) -> DataFrame:
    """block, clusters and centre: a block's slice of all centroids, cluster by cluster; as many values as centroids have in all."""
    return centroids.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("cluster", "dim", "value"))).alias("all")).select(
            "block", F.array_max(F.col("all.cluster")).alias("last"), F.col("all.value").alias("centre"))


def partial_distances(slices: DataFrame, centroids: DataFrame) -> DataFrame:
    """chunk, block, part: each slice's squared distances to the centroids over its own columns, vectors by clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, block, cells, last, centre in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = np.array(centre, np.int64).reshape(last + 1, -1)
                x = np.frombuffer(cells, "<i8").reshape(-1, c.shape[1])
                part = np.empty((len(x), len(c)), "<i8")
                for k in range(len(c)):
                    d = x - c[k]
                    part[:, k] = (d * d).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([block], pa.int32()),
                                                  pa.array([part.tobytes()], pa.binary()), pa.array([last + 1], pa.int32())],
                                                 ["chunk", "block", "part", "clusters"])

    # centroids by components values in all, whatever the number of vectors
    joined = slices.join(F.broadcast(_slices_of(centroids)), "block").select("chunk", "block", "cells", "last", "centre")
    return joined.mapInArrow(run, "chunk long, block int, part binary, clusters int")


def nearest(parts: DataFrame) -> DataFrame:
    """chunk, labels, distances: the blocks of each chunk added up, and the nearest centroid, the smaller number of equally near ones."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = clusters = None
        for batch in batches:  # as many rows as there are blocks
            for part, n in zip(batch.column("part").to_pylist(), batch.column("clusters").to_pylist(), strict=True):
                own, clusters = np.frombuffer(part, "<i8"), n
                total = own.copy() if total is None else total + own
        total = total.reshape(-1, clusters)
        labels = total.argmin(1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([labels.astype("<i4").tobytes()], pa.binary()),
             pa.array([total[np.arange(len(total)), labels].astype("<i8").tobytes()], pa.binary())], ["chunk", "labels", "distances"])

    return parts.groupBy("chunk").applyInArrow(add, "chunk long, labels binary, distances binary")


def moved(shards: Shards, labels: DataFrame, centroids: DataFrame, block: int = BLOCK) -> DataFrame:
    """The next centroids: each block adds up its columns by cluster; floor(sum / count), an empty cluster stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for b, cells, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                which = np.frombuffer(own, "<i4")
                x = np.frombuffer(cells, "<i8").reshape(len(which), -1)
                for k in np.unique(which).tolist():
                    held = x[which == k]
                    # Python integers: a task's sums may pass 64 bits
                    sums[b, k] = sums.get((b, k), 0) + held.sum(0).astype(object)
                    counts[b, k] = counts.get((b, k), 0) + len(held)
        rows = [(b, k, b * block + j, str(v), counts[b, k]) for (b, k), s in sums.items() for j, v in enumerate(s)]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    names = ["block", "cluster", "dim", "total", "rows"]
    schema = pa.schema([("block", pa.int32()), ("cluster", pa.int32()), ("dim", pa.int32()), ("total", pa.string()), ("rows", pa.int64())])
    # a row for each centroid's component and task: what a task adds up before it sends anything
    added = (shards.slices.join(labels.select("chunk", "labels"), "chunk").select("block", "cells", "labels")
             .mapInArrow(run, "block int, cluster int, dim int, total string, rows long")
             .groupBy("block", "cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                     F.sum("rows").cast("decimal(20,0)").alias("rows")))
    mean = added.select("block", "cluster", "dim", F.expr("(total - pmod(total, rows)) div rows").alias("mean"))
    return centroids.join(mean, ["block", "cluster", "dim"], "left").select(
        "block", "cluster", "dim", F.coalesce("mean", "value").alias("value"))


def centroid_digest(values: Column) -> Column:
    """Lowercase SHA-256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(values, lambda v: v.cast("string")), ","), 256)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
            components: int = COMPONENTS, block: int = BLOCK, chunk_rows: int = CHUNK_ROWS, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Assignments (vec_id, cluster, distance) and centroids (cluster, values) after ``rounds`` rounds of Lloyd's method.

    Vectors of another length, or with a null, NaN or infinite component, and null vectors are left out.
    Repeated rows each count; null ids are kept, and come last among the first centroids. Fewer vectors than
    ``clusters`` make fewer clusters, and none no rows. Components of above some 10^6 (times the scale: 1.3 * 10^8)
    raise an error, as their squared distances would not be exact.
    """
    folder = folder or workspace(vectors.sparkSession, "centroids")
    kept = kept_vectors(vectors, id_col, vector_col, components)
    shards = sliced(kept, folder, components, block, chunk_rows=chunk_rows)
    centroids = stored(first_centroids(kept, clusters, block=block), f"{folder}/centroids-0")
    for k in range(rounds):
        labels = nearest(partial_distances(shards.slices, centroids))
        centroids = stored(moved(shards, labels, centroids, block).coalesce(1), f"{folder}/centroids-{k + 1}")
    last = nearest(partial_distances(shards.slices, centroids))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0).slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.frombuffer(batch.column(1)[i].as_py(), "<i4")),
                                                  pa.array(np.frombuffer(batch.column(2)[i].as_py(), "<i8"))], ["vec_id", "cluster", "distance"])

    kind = id_type(kept, "vec_id")
    placed = shards.ids.join(last, "chunk").select("ids", "labels", "distances").mapInArrow(
        rows, f"vec_id {kind}, cluster int, distance long")
    whole = centroids.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("all")).select(
        "cluster", F.col("all.value").alias("values"))
    return stored(placed, f"{folder}/assigned"), whole


def report(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector.

    The inertias are null where they pass 64 bits.
    """
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own"))
    total = sums.agg(F.sum("own").alias("whole"))
    # a row for each centroid
    named = sums.join(centroids, "cluster").crossJoin(total).select(
        "cluster", F.expr("try_cast(own AS long)").alias("cluster_inertia"), F.expr("try_cast(whole AS long)").alias("inertia"),
        centroid_digest(F.col("values")).alias("centroid_sha256"))
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
