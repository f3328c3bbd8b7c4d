"""Centroid clustering against Lloyd's method on whole vectors in Python integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest

from funnelguard.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, clusters=8, rounds=10, components=64):
    """Rows of the report, by the definition; ``rows`` are pairs of id and list."""
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == components and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in order[:clusters]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centre))

    for _ in range(rounds):
        at = [place(v)[1] for _, v in kept]
        for k in range(len(centre)):
            own = [v for (_, v), j in zip(kept, at, strict=True) if j == k]
            if own:
                centre[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = [place(v) for _, v in kept]
    inertia = Counter()
    for d, k in at:
        inertia[k] += d
    return Counter((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centre[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(kept, at, strict=True))


def reported(df, **options):
    return Counter(map(tuple, centroids.report(*centroids.cluster(df, **options)).collect()))


def vectors(n, seed=0):
    """Vectors of halves, so that floats hold them exactly and many distances are equal."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-4, 5) / 2 + (i % 5) for _ in range(64)]) for i in range(n)]


@pytest.mark.parametrize("block,chunk_rows", [(16, 7), (64, 4096), (5, 50)])
def test_shards_do_not_change_the_result(spark, block, chunk_rows):
    rows = vectors(120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert reported(df, block=block, chunk_rows=chunk_rows) == expected(rows)


def test_vectors_that_are_left_out_and_other_columns(spark):
    rows = vectors(40, 1)
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [1.0] * 63 + [None]), (105, [1.0] * 63 + [float("nan")]),
           (106, [float("inf")] + [1.0] * 63), (107, [float("-inf")] * 64)]
    df = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS block", "2 AS cluster", "'c' AS chunk", "0 AS distance", "3 AS values")
    assert reported(df, rounds=4) == expected(rows, rounds=4)


def test_ties_repeated_rows_and_null_ids(spark):
    # equal centroids: all go to the smaller number and the others stay empty
    rows = [(i % 9, [float(i % 3)] * 64) for i in range(60)] + [(None, [0.5] * 64)] * 3
    assert reported(spark.createDataFrame(rows, SCHEMA), rounds=3) == expected(rows, rounds=3)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = vectors(5, 2)
    assert reported(spark.createDataFrame(rows, SCHEMA), rounds=2) == expected(rows, rounds=2)
    assert reported(spark.createDataFrame([(1, [1.0])], SCHEMA), rounds=2) == Counter()
    assert reported(spark.createDataFrame([], SCHEMA), rounds=2) == Counter()


def test_floor_of_negative_means_and_doubles(spark):
    rows = [(i, [x * ((-1) ** i) + 1e-9 * i for x in (0.1, -0.3, 2.7)]) for i in range(25)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert reported(df, components=3, clusters=3, block=2) == expected(rows, clusters=3, components=3)


def test_components_beyond_exact_distances_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)
    with pytest.raises(Exception, match="no longer fit 64 bits"):
        centroids.cluster(df)
