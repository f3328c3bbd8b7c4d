"""flowInterruption (F1-F7): minutes since a vertical's last conversion against its usual gap.

The usual gap is the lower median of the gaps between consecutive
conversions of the last four weeks (gaps over 12 hours ignored). Gaps are
computed per vertical and slice of time, as segments that merge in the order
of their slices, instead of one sort of a whole vertical in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import INF, fired
from ..functions.stats import segment_gaps, weighted_median
from ..functions.timewin import format_ts, micros
from ..schemas import FLOW_INTERRUPTION, LABEL_CONTROLLED_MINUTES, LABEL_DYNAMIC_MINUTES, LABEL_MINUTES_SINCE
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope

MICROS_PER_MINUTE = 60_000_000


def last_conversion(scope: Scope) -> DataFrame:
    """F1: (vertical_name, last_us) latest conversion before as_of, epoch micros; NULL if none.

    Read from today's conversions and the segments of the four weeks before; only the campaigns of verticals without
    any conversion in these are searched for in the older facts.
    """
    today = scope.per_vertical(scope.conversions.where(scope.within(scope.clock.today, scope.clock.now)), [],
                               [F.max("last_us").alias("last_us")])
    recent = (today.unionByName(scope.conversion_segments.select("vertical_name", "last_us"))
              .groupBy("vertical_name").agg(F.max("last_us").alias("last_us")))
    silent = scope.shared("silent_campaigns", lambda: scope.pairs.join(recent, "vertical_name", "left_anti")
                          .select("campaign_id").distinct())
    older = scope.per_vertical(scope.older_conversions(silent), [], [F.max("last_us").alias("last_us")])
    found = recent.unionByName(older).groupBy("vertical_name").agg(F.max("last_us").alias("last_us"))
    return scope.verticals.join(found, "vertical_name", "left")


def minutes_since_conversion(scope: Scope) -> DataFrame:
    """(vertical_name, minutes_since_conversion): whole minutes, +inf if never."""
    now_us = F.lit(micros(scope.clock.now))
    minutes = F.floor((now_us - F.col("last_us")) / F.lit(MICROS_PER_MINUTE)).cast("double")
    return last_conversion(scope).select(
        "vertical_name", F.coalesce(minutes, F.lit(INF)).alias("minutes_since_conversion"))


def gap_counts(scope: Scope) -> DataFrame:
    """(vertical_name, gap_seconds, n): gaps between consecutive conversions of a vertical's active campaigns.

    Conversions in [as_of - 4 weeks, midnight of as_of); a histogram, merged from segments of time.
    """
    return segment_gaps(scope.conversion_segments, ["vertical_name"])


def conversion_gaps(scope: Scope) -> DataFrame:
    """(vertical_name, gap_minutes), one row per consecutive pair of conversions; whole seconds divided by 60."""
    rows = gap_counts(scope).select("vertical_name", "gap_seconds", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return rows.select("vertical_name", (F.col("gap_seconds") / 60).alias("gap_minutes"))


def gap_median(scope: Scope) -> DataFrame:
    """(vertical_name, median_gap_minutes, num_gaps) over gaps up to the relevant maximum.

    The exact lower median, over a histogram of whole-second gaps.
    """
    p = scope.params
    gaps = gap_counts(scope).select("vertical_name", (F.col("gap_seconds") / 60).alias("gap_minutes"), "n")
    counts = (gaps.where(F.col("gap_minutes") <= p.flow_max_relevant_gap_minutes)
              .groupBy("vertical_name", "gap_minutes").agg(F.sum("n").alias("n")))
    stats = weighted_median(counts, ["vertical_name"], "gap_minutes", "n", "median_gap_minutes").join(
        counts.groupBy("vertical_name").agg(F.sum("n").alias("num_gaps")), "vertical_name")
    return (scope.verticals.join(stats, "vertical_name", "left")
            .select("vertical_name", "median_gap_minutes",
                    F.coalesce("num_gaps", F.lit(0).cast("long")).alias("num_gaps")))


def gap_threshold(scope: Scope) -> DataFrame:
    """dynamic threshold max(5, median * multiplier), a missing median read as 0."""
    p = scope.params
    median = F.coalesce("median_gap_minutes", F.lit(0.0))
    return gap_median(scope).withColumn(
        "dynamic_threshold",
        F.greatest(F.lit(float(p.flow_min_dynamic_threshold_minutes)),
                   median * p.flow_interruption_automated_multiplier).cast("double"))


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("spend_today") > p.min_spend_for_cpa_alert) & (F.col("minutes_since_conversion") > eff))


def _automated_fired(p) -> Column:
    return fired((F.col("num_gaps") >= p.flow_interruption_min_historical_gaps)
                 & (F.coalesce("median_gap_minutes", F.lit(0.0)) > 0)
                 & (F.col("minutes_since_conversion") > F.col("dynamic_threshold"))
                 & (F.col("spend_today") > p.min_spend_for_cpa_alert))


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """minutes since the last conversion above the fixed threshold while spending today."""
    return (scope.rows("vertical_metrics", (FLOW_INTERRUPTION,)).join(thresholds, "vertical_name", "left")
            .select("vertical_name", "minutes_since_conversion", "spend_today", "base_threshold",
                    "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """minutes above the dynamic threshold, with enough history and a positive median."""
    return (scope.rows("vertical_metrics", (FLOW_INTERRUPTION,))
            .select("vertical_name", "minutes_since_conversion", "spend_today", "median_gap_minutes", "num_gaps",
                    "dynamic_threshold", _automated_fired(scope.params).alias("fired")))


def last_conversion_text(scope: Scope) -> DataFrame:
    """F1 rendered for comparison across engines: timestamp as text with microseconds."""
    return last_conversion(scope).select(
        "vertical_name", format_ts(F.timestamp_micros("last_us"), micros=True).alias("last_conversion_dt"))


def branches(p) -> dict:
    """Alert branches over vertical_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return _controlled_fired(p, eff), record(
            FLOW_INTERRUPTION, value="minutes_since_conversion", value_timeframe=LABEL_MINUTES_SINCE,
            benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED_MINUTES, spend="spend_today", base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_fired(p), record(
            FLOW_INTERRUPTION, value="minutes_since_conversion", value_timeframe=LABEL_MINUTES_SINCE,
            benchmark="dynamic_threshold", benchmark_timeframe=LABEL_DYNAMIC_MINUTES, spend="spend_today")
    return {CONTROLLED: ctrl, AUTOMATED: auto}
