"""highCPA (C1-C12): current 6-hour cost per acquisition against a robust benchmark.

Benchmark: the same weekday over the last four weeks, in hour buckets
labelled six hours earlier; CPA per bucket; buckets trimmed to the
campaign's 10th..90th percentile; volume-weighted median plus a scaled
weighted MAD.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import INF, fired, ratio
from ..functions.stats import percentile_trim, weighted_mad, weighted_median
from ..schemas import HIGH_CPA, LABEL_CONTROLLED, LABEL_LAST_6_HOURS, LABEL_WEIGHTED_MAD
from .records import record
from .rollups import HOUR_US, hour_start, weekday
from .scope import AUTOMATED, CONTROLLED, Scope

BUCKET_SHIFT_HOURS = 6


def spend_6h(scope: Scope) -> DataFrame:
    """(campaign_id, current_6h_spend) for campaigns with hourly rows in the last 6 hours."""
    c = scope.clock
    return (scope.hourly.where(scope.within(c.ago(hours=6), c.now))
            .groupBy("campaign_id").agg(F.sum("spend").cast("double").alias("current_6h_spend")))


def volume_6h(scope: Scope) -> DataFrame:
    """(campaign_id, current_6h_volume) conversions in the last 6 hours."""
    c = scope.clock
    return (scope.conversions.where(scope.within(c.ago(hours=6), c.now))
            .groupBy("campaign_id").agg(F.sum("n_sid").cast("long").alias("current_6h_volume")))


def current_by_campaign(scope: Scope) -> DataFrame:
    """C3 before scoping: full outer join of C1 and C2, CPA = spend / volume (inf at volume 0)."""
    joined = spend_6h(scope).join(volume_6h(scope), "campaign_id", "full")
    if scope.params.missing == "zero":
        joined = joined.fillna({"current_6h_spend": 0.0, "current_6h_volume": 0})
    return joined.withColumn("current_6h_cpa", ratio("current_6h_spend", "current_6h_volume", INF))


def current(scope: Scope) -> DataFrame:
    """Current CPA of active campaigns (vertical_name, campaign_id, spend, volume, cpa)."""
    return scope.per_campaign(current_by_campaign(scope))


def _history(scope: Scope, rollup: DataFrame, value: Column, name: str) -> DataFrame:
    """Per (campaign, hour bucket labelled 6 hours earlier) on the as_of weekday of the last 4 weeks."""
    c = scope.clock
    hi = c.now if scope.params.cpa_history_includes_today else c.today
    label = (hour_start() - F.lit(BUCKET_SHIFT_HOURS * HOUR_US)).alias("window_start")
    return (rollup.where(scope.within(c.ago(days=28), hi) & (weekday() == c.dayofweek))
            .groupBy("campaign_id", label).agg(value.alias(name)))


def spend_history(scope: Scope) -> DataFrame:
    """C4: (campaign_id, window_start [epoch micros], window_spend)."""
    return _history(scope, scope.hourly, F.sum("spend").cast("double"), "window_spend")


def volume_history(scope: Scope) -> DataFrame:
    """(campaign_id, window_start, window_volume), same buckets on conversion time."""
    return _history(scope, scope.conversions, F.sum("n_sid").cast("long"), "window_volume")


def history(scope: Scope) -> DataFrame:
    """CPA per (campaign, bucket) for active campaigns; full outer join of C4 and C5."""
    active_ids = scope.pairs.select("campaign_id").distinct()
    return (spend_history(scope).join(volume_history(scope), ["campaign_id", "window_start"], "full")
            .join(active_ids, "campaign_id", "left_semi")
            .withColumn("cpa", ratio("window_spend", "window_volume", INF)))


def trimmed(scope: Scope) -> DataFrame:
    """Buckets whose CPA is inside the campaign's [p10, p90] (approximate, accuracy 1000).

    Materialised once per scope: the median and the MAD both read it.
    """
    p = scope.params
    return scope.shared("cpa_trimmed", lambda: percentile_trim(history(scope), ["campaign_id"], "cpa", p.cpa_trim_low,
                                                               p.cpa_trim_high, p.cpa_trim_accuracy))


def benchmark(scope: Scope) -> DataFrame:
    """(campaign_id, weighted_median_cpa, weighted_mad_cpa, high_cpa_threshold).

    Campaigns whose threshold is NULL or infinite are dropped.
    """
    p = scope.params
    kept = trimmed(scope)
    med = weighted_median(kept, ["campaign_id"], "cpa", "window_volume", "weighted_median_cpa")
    mad = weighted_mad(kept, med, ["campaign_id"], "cpa", "window_volume", "weighted_median_cpa",
                       "weighted_mad_cpa")
    threshold = (F.col("weighted_median_cpa")
                 + F.col("weighted_mad_cpa") * p.cpa_mad_scaling_factor * p.cpa_mad_threshold_multiplier)
    return (med.join(mad, "campaign_id", "inner")
            .withColumn("high_cpa_threshold", threshold)
            .where(F.col("high_cpa_threshold").isNotNull() & (F.col("high_cpa_threshold") != F.lit(INF))))


def _controlled_values(p, eff: Column):
    """CPA, spend, volume as the fixed-threshold rule reads them, and whether it fires."""
    present = F.col("cpa_present")
    cpa = F.when(present, F.coalesce("current_6h_cpa", F.lit(0.0))).otherwise(F.lit(INF))
    spend = F.when(present, F.col("current_6h_spend")).otherwise(F.lit(0.0))
    volume = F.when(present, F.coalesce("current_6h_volume", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    return cpa, spend, volume, fired((cpa > eff) & (spend > p.min_spend_for_cpa_alert))


def _automated_row() -> Column:
    return F.col("cpa_present") & F.col("high_cpa_threshold").isNotNull()


def _automated_fired(p) -> Column:
    return fired((F.col("current_6h_cpa") > F.col("high_cpa_threshold"))
                 & (F.col("high_cpa_threshold") != F.lit(INF))
                 & (F.col("current_6h_spend") > p.min_spend_for_cpa_alert))


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """C11: every active campaign against its vertical's fixed threshold.

    A campaign with current rows uses its CPA (NULL read as 0) and volume
    (NULL read as 0); one without rows has CPA inf and spend 0, so it never
    fires. ``thresholds``: (vertical_name, base_threshold, effective_threshold).
    """
    cpa, spend, volume, fire = _controlled_values(scope.params, F.col("effective_threshold"))
    return (scope.rows("campaign_metrics", (HIGH_CPA,)).join(thresholds, "vertical_name", "left")
            .select("vertical_name", "campaign_id", "campaign_name", cpa.alias("current_6h_cpa"),
                    spend.alias("current_6h_spend"), volume.alias("current_6h_volume"),
                    "base_threshold", "effective_threshold", fire.alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """Current CPA of active campaigns with a benchmark, and whether it exceeds it."""
    return (scope.rows("campaign_metrics", (HIGH_CPA,)).where(_automated_row())
            .select("campaign_id", "vertical_name", "campaign_name", "current_6h_spend", "current_6h_volume",
                    "current_6h_cpa", "weighted_median_cpa", "weighted_mad_cpa", "high_cpa_threshold",
                    _automated_fired(scope.params).alias("fired")))


def branches(p) -> dict:
    """Alert branches over campaign_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        cpa, spend, volume, fire = _controlled_values(p, eff)
        return fire, record(HIGH_CPA, campaign=True, value=cpa, value_timeframe=LABEL_LAST_6_HOURS,
                            benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED,
                            spend=spend, leads=volume, base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_row() & _automated_fired(p), record(
            HIGH_CPA, campaign=True, value="current_6h_cpa", value_timeframe=LABEL_LAST_6_HOURS,
            benchmark="high_cpa_threshold", benchmark_timeframe=LABEL_WEIGHTED_MAD,
            spend="current_6h_spend", leads="current_6h_volume")
    return {CONTROLLED: ctrl, AUTOMATED: auto}
