"""clickoutToConversion (X1-X4): conversions per click-out today against the same weekday a week ago.

Conversions are counted by conversion date (with a payout), click-outs by
session date (plain row count), from the conversion and session rollups;
a window without matching fact rows gives NULL, as after an outer join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import fired, ratio, sum_if_rows
from ..schemas import CLICKOUT_TO_CONVERSION, LABEL_CONTROLLED, LABEL_LAST_WEEK_CR, LABEL_TODAY
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope


def by_campaign(scope: Scope) -> DataFrame:
    c, p = scope.clock, scope.params
    today = scope.within(c.today, c.now)
    week = scope.within(c.days_before_today(7), c.days_before_today(6))
    conversions = (scope.conversions.where(today | week)
                   .groupBy("campaign_id")
                   .agg(_count_if_rows(today, "n_paid", "n_paid_sid").alias("todays_conversions"),
                        _count_if_rows(week, "n_paid", "n_paid_sid").alias("last_week_conversions")))
    clickouts = (scope.sessions.where(today | week)
                 .groupBy("campaign_id")
                 .agg(_count_if_rows(today, "n_out", "n_out_sid").alias("todays_clickouts"),
                      _count_if_rows(week, "n_out", "n_out_sid").alias("last_week_clickouts")))
    rows = conversions.join(clickouts, "campaign_id", "full")
    rows = rows.select(
        "*",
        (F.col("todays_conversions").isNotNull() | F.col("todays_clickouts").isNotNull()).alias("_today"),
        (F.col("last_week_conversions").isNotNull() | F.col("last_week_clickouts").isNotNull()).alias("_week"))
    if p.missing == "zero":
        rows = rows.fillna(0, ["todays_conversions", "todays_clickouts", "last_week_conversions",
                               "last_week_clickouts"])
    return rows.select("*", ratio("todays_conversions", "todays_clickouts", 0.0).alias("todays_cr"),
                       ratio("last_week_conversions", "last_week_clickouts", 0.0).alias("last_week_cr"))


def _count_if_rows(cond, rows: str, counted: str):
    return sum_if_rows(cond, rows, counted).cast("long")


def rate_today(scope: Scope) -> DataFrame:
    """(vertical_name, campaign_id, todays_conversions, todays_clickouts, todays_cr)."""
    rows = by_campaign(scope).where("_today")
    return scope.per_campaign(rows.select("campaign_id", "todays_conversions", "todays_clickouts", "todays_cr"))


def rate_week_ago(scope: Scope) -> DataFrame:
    """The same for the single date seven days before as_of."""
    rows = by_campaign(scope).where("_week")
    return scope.per_campaign(rows.select("campaign_id", "last_week_conversions", "last_week_clickouts",
                                          "last_week_cr"))


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("todays_cr") < eff) & (F.col("todays_clickouts") >= p.min_clickouts_for_cr_alert))


def _benchmark(p) -> Column:
    return F.col("last_week_cr") * p.clickout_to_conversion_factor


def _automated_fired(p) -> Column:
    return fired((F.col("last_week_cr") > 0) & (F.col("todays_cr") < _benchmark(p))
                 & (F.col("todays_clickouts") >= p.min_clickouts_for_cr_alert))


def _automated_row() -> Column:
    return F.col("cr_today_row") & F.col("cr_week_row")


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """Rate below the fixed threshold with at least the minimum click-outs."""
    return (scope.rows("campaign_metrics", (CLICKOUT_TO_CONVERSION,)).where("cr_today_row").join(thresholds, "vertical_name", "left")
            .select("vertical_name", "campaign_id", "campaign_name", "todays_cr", "todays_clickouts",
                    "base_threshold", "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """Rate below the week-ago rate times the factor (week-ago rate > 0)."""
    p = scope.params
    return (scope.rows("campaign_metrics", (CLICKOUT_TO_CONVERSION,)).where(_automated_row())
            .select("campaign_id", "vertical_name", "campaign_name", "todays_cr", "todays_clickouts",
                    "last_week_cr", _benchmark(p).alias("benchmark"), _automated_fired(p).alias("fired")))


def branches(p) -> dict:
    """Alert branches over campaign_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return F.col("cr_today_row") & _controlled_fired(p, eff), record(
            CLICKOUT_TO_CONVERSION, campaign=True, value="todays_cr", value_timeframe=LABEL_TODAY,
            benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED, base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_row() & _automated_fired(p), record(
            CLICKOUT_TO_CONVERSION, campaign=True, value="todays_cr", value_timeframe=LABEL_TODAY,
            benchmark=_benchmark(p),
            benchmark_timeframe=LABEL_LAST_WEEK_CR.format(factor=p.clickout_to_conversion_factor))
    return {CONTROLLED: ctrl, AUTOMATED: auto}
