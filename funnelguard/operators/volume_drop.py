"""volumeDrop (V1-V5): conversions in the last hour of a vertical against the same hour of past days.

One pass over the conversion rollup gives, per campaign, the last-hour
count and the same-hour count of each of the 7 previous days (seven
conditional sums instead of a per-day group); campaigns are then rolled up
to their vertical. Verticals without conversions keep a row with 0.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import fired
from ..schemas import LABEL_CONTROLLED, LABEL_LAST_1_HOUR, LABEL_SAME_HOUR_AVG, VOLUME_DROP
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope

HISTORY_DAYS = 7


def _day_col(k: int) -> str:
    return f"_d{k}"


def _conversions(scope: Scope) -> DataFrame:
    """Per vertical: last-hour conversions and same-hour conversions of each previous day."""
    c = scope.clock
    hour_start = c.today + timedelta(hours=c.hour)
    last_hour = scope.within(c.ago(hours=1), c.now)
    days = [scope.within(hour_start - timedelta(days=k), hour_start - timedelta(days=k, hours=-1))
            for k in range(1, HISTORY_DAYS + 1)]
    wanted = last_hour
    for day in days:
        wanted = wanted | day
    per_campaign = (scope.conversions.where(wanted).groupBy("campaign_id")
                    .agg(F.sum(F.when(last_hour, F.col("n"))).alias("_last_hour"),
                         *[F.sum(F.when(day, F.col("n"))).alias(_day_col(k)) for k, day in enumerate(days, 1)]))
    rolled = scope.per_vertical(per_campaign, [],
                                [F.sum("_last_hour").cast("long").alias("_last_hour")]
                                + [F.sum(_day_col(k)).cast("long").alias(_day_col(k))
                                   for k in range(1, HISTORY_DAYS + 1)])
    return scope.verticals.join(rolled, "vertical_name", "left")


def spend_today(scope: Scope) -> DataFrame:
    """V2: (vertical_name, spend_today) from the hourly facts since midnight; 0 when none."""
    c = scope.clock
    per_campaign = (scope.hourly.where(scope.within(c.today, c.now))
                    .groupBy("campaign_id").agg(F.sum("spend").alias("_spend")))
    rolled = scope.per_vertical(per_campaign, [], [F.sum("_spend").cast("double").alias("spend_today")])
    return (scope.verticals.join(rolled, "vertical_name", "left")
            .select("vertical_name", F.coalesce("spend_today", F.lit(0.0)).alias("spend_today")))




def conversions_last_hour(scope: Scope) -> DataFrame:
    """V1: (vertical_name, conversions_last_hour)."""
    return volumes(scope).select("vertical_name", "conversions_last_hour")


def same_hour_average(scope: Scope) -> DataFrame:
    """V3: (vertical_name, same_hour_avg, days_with_conversions).

    Average conversions in the as_of hour of day over the 7 previous days,
    over the days that have conversions (or over all 7 with
    ``volume_avg_zero_fill``); 0 when there are none.
    """
    return volumes(scope).select("vertical_name", "same_hour_avg", "days_with_conversions")


def volumes(scope: Scope) -> DataFrame:
    """V1 and V3 from one pass: (vertical_name, conversions_last_hour, same_hour_avg, days_with_conversions)."""
    days = [F.coalesce(F.col(_day_col(k)), F.lit(0).cast("long")) for k in range(1, HISTORY_DAYS + 1)]
    total = sum(days[1:], days[0])
    with_rows = sum([F.when(d > 0, 1).otherwise(0) for d in days[1:]], F.when(days[0] > 0, 1).otherwise(0))
    divisor = F.lit(HISTORY_DAYS) if scope.params.volume_avg_zero_fill else with_rows
    return _conversions(scope).select(
        "vertical_name",
        F.coalesce("_last_hour", F.lit(0).cast("long")).alias("conversions_last_hour"),
        F.when(with_rows > 0, total / divisor).otherwise(F.lit(0.0)).cast("double").alias("same_hour_avg"),
        with_rows.cast("long").alias("days_with_conversions"))


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("conversions_last_hour") < eff) & (F.col("spend_today") > p.min_spend_for_cpa_alert))


def _benchmark(p) -> Column:
    return F.col("same_hour_avg") * p.volume_drop_factor


def _automated_fired(p) -> Column:
    return fired((F.col("same_hour_avg") > 0) & (F.col("conversions_last_hour") < _benchmark(p))
                 & (F.col("spend_today") > p.min_spend_for_cpa_alert))


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """V4: last-hour volume below the fixed threshold while the vertical spends today."""
    return (scope.rows("vertical_metrics", (VOLUME_DROP,)).join(thresholds, "vertical_name", "left")
            .select("vertical_name", "conversions_last_hour", "spend_today", "base_threshold",
                    "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """V5: last-hour volume below the same-hour average times (1 - drop percentage)."""
    p = scope.params
    return (scope.rows("vertical_metrics", (VOLUME_DROP,))
            .select("vertical_name", "conversions_last_hour", "spend_today", "same_hour_avg",
                    "days_with_conversions", _benchmark(p).alias("benchmark"), _automated_fired(p).alias("fired")))


def branches(p) -> dict:
    """Alert branches over vertical_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return _controlled_fired(p, eff), record(
            VOLUME_DROP, value="conversions_last_hour", value_timeframe=LABEL_LAST_1_HOUR, benchmark=eff,
            benchmark_timeframe=LABEL_CONTROLLED, spend="spend_today", base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_fired(p), record(
            VOLUME_DROP, value="conversions_last_hour", value_timeframe=LABEL_LAST_1_HOUR,
            benchmark=_benchmark(p), benchmark_timeframe=LABEL_SAME_HOUR_AVG, spend="spend_today")
    return {CONTROLLED: ctrl, AUTOMATED: auto}
