"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each u with the least of its neighbours v: a row for each task and u at most is shuffled, so a hub spreads."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def stars(edges: DataFrame, folder: str) -> DataFrame:
    """u, v: every node u that is not the least of its component, with that least node v.

    ``edges`` has columns a and b of one orderable type; loops and repeats do no harm. A round writes its
    edges to ``folder``, and the rounds end when the edges no longer change (a logarithmic number).
    """
    current = (edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, k = None, 0
    while True:
        current = stored(current, f"{folder}/round-{k}")
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            return current
        before, k = now, k + 1
        current = _small_star(_large_star(current))
