"""Robust statistics as DataFrame plans, generic over key / value / weight columns.

All of them start from grouped, already small inputs (one row per time
bucket, or per distinct value) so a window never holds more than the
distinct values of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str,
                    out: str = "weighted_median") -> DataFrame:
    """Per key: the smallest ``value`` whose cumulative weight (ascending) reaches half the total.

    Rows are first collapsed to one per distinct (key, value) so ties in
    ``value`` cannot make the answer depend on row order, and the window
    only spans the distinct values of a key. Rows with a NULL value or
    weight do not take part. Returns ``keys + [out]``.
    """
    keys = list(keys)
    per_value = (df.where(F.col(value).isNotNull() & F.col(weight).isNotNull())
                 .groupBy(*keys, value).agg(F.sum(weight).alias("_w")))
    running = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    return (per_value
            .withColumn("_cum", F.sum("_w").over(running))
            .withColumn("_half", F.sum("_w").over(whole) / 2.0)
            .where(F.col("_cum") >= F.col("_half"))
            .groupBy(*keys).agg(F.min(value).alias(out)))


def weighted_mad(df: DataFrame, medians: DataFrame, keys: Sequence[str], value: str, weight: str,
                 median: str, out: str = "weighted_mad") -> DataFrame:
    """Per key: the weighted median of ``|value - median|`` with the same weights.

    ``medians`` holds ``keys + [median]``. Returns ``keys + [out]``.
    """
    keys = list(keys)
    deviations = (df.join(medians, keys, "inner")
                  .select(*keys, F.abs(F.col(value) - F.col(median)).alias("_dev"), weight))
    return weighted_median(deviations, keys, "_dev", weight, out)


def percentile_trim(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float,
                    accuracy: int) -> DataFrame:
    """Keep rows whose ``value`` lies in the per-key [low, high] approximate percentiles, inclusive.

    The percentiles come from a grouped ``percentile_approx`` (partial
    sketches merged after the shuffle) joined back on the key, instead of a
    window that would buffer each key's rows in one task. Rows with a NULL
    value, and keys with no value, are dropped.
    """
    keys = list(keys)
    bounds = (df.groupBy(*keys)
              .agg(F.percentile_approx(value, [low, high], accuracy).alias("_q")))
    return (df.join(bounds, keys, "inner")
            .where((F.col(value) >= F.col("_q")[0]) & (F.col(value) <= F.col("_q")[1]))
            .drop("_q"))


#: Slices whose ends are stitched together in the lower level of the tree.
SLICES_TOGETHER = 24


def gap_segments(df: DataFrame, keys: Sequence[str], second: str, count: str, slice_seconds: int, extra: Sequence[Column] = ()) -> DataFrame:
    """A segment for each key and slice of time: keys + [slice, first, last, gaps] and the aggregates ``extra``.

    ``df`` has counts per key and whole second; ``count`` rows at a second make ``count - 1`` gaps of 0. ``gaps`` are the
    differences of neighbouring instants inside the slice, as (gap, n). Segments of one key merge in the order of
    their slices: gaps add up, and one more lies between the last instant of one and the first of the next.
    At most ``slice_seconds`` entries are collected for a slice, however many rows stand in it.
    """
    keys = list(keys)
    # one array per slice, from rows that are already one per second: no window, and no sort of a whole key
    rows = (df.groupBy(*keys, F.floor(F.col(second) / F.lit(slice_seconds)).alias("slice"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col(second).cast("long").alias("s"), F.col(count).cast("long").alias("n")))).alias("at"), *extra))
    others = [c for c in rows.columns if c not in (*keys, "slice", "at")]
    inner = F.expr("transform(slice(at, 2, size(at) - 1), (x, i) -> struct(x.s - at[i].s as gap, 1L as n))")
    again = F.expr("transform(filter(at, x -> x.n > 1), x -> struct(0L as gap, x.n - 1 as n))")
    return rows.select(*keys, "slice", F.element_at("at", 1)["s"].alias("first"), F.element_at("at", -1)["s"].alias("last"),
                       F.concat(inner, again).alias("gaps"), *others)


def _stitched(ends: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """keys + [first, last, gaps] of the ends (first, last) of consecutive segments: the gaps between them."""
    rows = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "first", "last"))).alias("at"))
    between = F.expr("transform(slice(at, 2, size(at) - 1), (x, i) -> struct(x.first - at[i].last as gap, 1L as n))")
    return rows.select(*keys, F.element_at("at", 1)["first"].alias("first"), F.element_at("at", -1)["last"].alias("last"),
                       between.alias("gaps"))


def segment_gaps(segments: DataFrame, keys: Sequence[str], out: str = "gap_seconds") -> DataFrame:
    """The gaps of merged segments, keys + [out, "n"]: a histogram, one row per key and distinct gap.

    The ends of segments go up a tree of two levels (:data:`SLICES_TOGETHER` slices, then a key); their histograms
    never do, they are added up by gap.
    """
    keys = list(keys)
    days = _stitched(segments.select(*keys, F.floor(F.col("slice") / SLICES_TOGETHER).alias("day"), "slice", "first", "last"),
                     [*keys, "day"], "slice")
    whole = _stitched(days, keys, "day")
    every = [df.select(*keys, F.explode("gaps").alias("g")) for df in (segments, days, whole)]
    rows = every[0].unionByName(every[1]).unionByName(every[2])
    return rows.groupBy(*keys, F.col("g.gap").alias(out)).agg(F.sum("g.n").alias("n"))


def consecutive_gaps(df: DataFrame, keys: Sequence[str], second: str, count: str, slice_seconds: int,
                     out: str = "gap_seconds") -> DataFrame:
    """Per key: differences between consecutive instants, from counts per whole second.

    Equivalent to ``lag`` over the single rows of a key, without sorting them, nor a whole key in one task. Returns
    ``keys + [out, "n"]``: distinct gaps (bigint seconds) and how many of each there are.
    """
    return segment_gaps(gap_segments(df, keys, second, count, slice_seconds), keys, out)
