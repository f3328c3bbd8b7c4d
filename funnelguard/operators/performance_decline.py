"""performanceDecline (P1-P4): today's return on spend against last week's.

"ROI" is revenue / spend (payout over cost, cost not subtracted). Revenue
comes from the conversion rollup, spend from the daily facts; each is read
once for both windows with conditional aggregates, and a ``_rev_*`` /
``_spend_*`` flag keeps the outer-join meaning of "this side had rows".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import INF, any_row, fired, ratio
from ..functions.timewin import date_lit
from ..schemas import LABEL_CONTROLLED, LABEL_LAST_WEEK_ROI, LABEL_TODAY, PERFORMANCE_DECLINE
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope


def by_campaign(scope: Scope) -> DataFrame:
    """Revenue and spend of today and of the 7 previous days, per campaign (one pass over each rollup)."""
    c, p = scope.clock, scope.params
    today = scope.within(c.today, c.now)
    week = scope.within(c.days_before_today(7), c.today)
    revenue = (scope.conversions.where(today | week)
               .groupBy("campaign_id")
               .agg(F.sum(F.when(today, F.col("payout"))).cast("double").alias("todays_revenue"),
                    any_row(today).alias("_rev_today"),
                    F.sum(F.when(week, F.col("payout"))).cast("double").alias("last_week_revenue"),
                    any_row(week).alias("_rev_week")))
    today_row = F.col("date") == date_lit(c.today_date)
    week_row = (F.col("date") >= date_lit(c.days_before_today(7))) & (F.col("date") < date_lit(c.today_date))
    spend = (scope.daily_spend
             .groupBy("campaign_id")
             .agg(F.sum(F.when(today_row, F.col("spend"))).cast("double").alias("todays_spend"),
                  any_row(today_row).alias("_spend_today"),
                  F.sum(F.when(week_row, F.col("spend"))).cast("double").alias("last_week_spend"),
                  any_row(week_row).alias("_spend_week")))
    joined = revenue.join(spend, "campaign_id", "full")
    if p.missing == "zero":
        joined = joined.fillna(0.0, ["todays_revenue", "todays_spend", "last_week_revenue", "last_week_spend"])
    return joined.select(
        "*",
        _either("_rev_today", "_spend_today").alias("_today"),
        _either("_rev_week", "_spend_week").alias("_week"),
        ratio("todays_revenue", "todays_spend", INF).alias("todays_roi"),
        ratio("last_week_revenue", "last_week_spend", INF).alias("last_week_roi"))


def _either(a: str, b: str) -> Column:
    return F.coalesce(F.col(a), F.lit(False)) | F.coalesce(F.col(b), F.lit(False))


def roi_today(scope: Scope) -> DataFrame:
    """(vertical_name, campaign_id, todays_revenue, todays_spend, todays_roi)."""
    rows = by_campaign(scope).where("_today")
    return scope.per_campaign(rows.select("campaign_id", "todays_revenue", "todays_spend", "todays_roi"))


def roi_last_week(scope: Scope) -> DataFrame:
    """Same over the 7 days before the as_of date (a ratio of sums)."""
    rows = by_campaign(scope).where("_week")
    return scope.per_campaign(rows.select("campaign_id", "last_week_revenue", "last_week_spend", "last_week_roi"))


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("todays_spend") > p.min_spend_for_roi_alert) & (F.col("todays_roi") < eff))


def _benchmark(p) -> Column:
    return F.col("last_week_roi") * p.performance_decline_drop_factor


def _automated_fired(p) -> Column:
    return fired((F.col("todays_spend") > p.min_spend_for_roi_alert)
                 & (F.col("last_week_spend") > p.min_spend_for_roi_alert)
                 & (F.col("last_week_roi") != F.lit(INF))
                 & (F.col("todays_roi") < _benchmark(p)))


def _automated_row() -> Column:
    return F.col("roi_today_row") & F.col("roi_week_row")


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """Active campaigns with rows today, ROI below the fixed threshold and spend above the minimum."""
    return (scope.rows("campaign_metrics", (PERFORMANCE_DECLINE,)).where("roi_today_row").join(thresholds, "vertical_name", "left")
            .select("vertical_name", "campaign_id", "campaign_name", "todays_roi", "todays_spend",
                    "base_threshold", "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """today's ROI below last week's times the drop factor, both spends above the minimum."""
    p = scope.params
    return (scope.rows("campaign_metrics", (PERFORMANCE_DECLINE,)).where(_automated_row())
            .select("campaign_id", "vertical_name", "campaign_name", "todays_roi", "todays_spend",
                    "last_week_roi", "last_week_spend", _benchmark(p).alias("benchmark"),
                    _automated_fired(p).alias("fired")))


def branches(p) -> dict:
    """Alert branches over campaign_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return F.col("roi_today_row") & _controlled_fired(p, eff), record(
            PERFORMANCE_DECLINE, campaign=True, value="todays_roi", value_timeframe=LABEL_TODAY,
            benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED, spend="todays_spend", base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_row() & _automated_fired(p), record(
            PERFORMANCE_DECLINE, campaign=True, value="todays_roi", value_timeframe=LABEL_TODAY,
            benchmark=_benchmark(p),
            benchmark_timeframe=LABEL_LAST_WEEK_ROI.format(factor=p.performance_decline_drop_factor),
            spend="todays_spend")
    return {CONTROLLED: ctrl, AUTOMATED: auto}
