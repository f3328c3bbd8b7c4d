"""highLpAbandonment (L1-L6): sessions that start on a landing page but never reach the loader step.

Started sessions come from the session rollup (last 24 h), successes from
the daily funnel ("loader" step, by date). Both are aggregated per
(campaign, page) in one pass for the current and previous windows, then
rolled up to (vertical, page) over the vertical's active campaigns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import fired, sum_if_rows
from ..functions.timewin import date_lit
from ..schemas import HIGH_LP_ABANDONMENT, LABEL_CONTROLLED, LABEL_LAST_24_HOURS, LABEL_LAST_WEEK_RATE
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope

LOADER_STEP = "loader"


def _started(scope: Scope) -> DataFrame:
    c = scope.clock
    cur = scope.within(c.ago(hours=24), c.now)
    prev = scope.within(c.ago(days=8), c.ago(days=1))
    per_campaign = (scope.sessions.where(cur | prev)
                    .groupBy("campaign_id", "page")
                    .agg(sum_if_rows(cur, "n", "n_sid").alias("_cur"),
                         sum_if_rows(prev, "n", "n_sid").alias("_prev")))
    return scope.per_vertical(per_campaign, ["page"],
                              [F.sum("_cur").cast("long").alias("total_started"),
                               F.sum("_prev").cast("long").alias("last_week_started")])


def _successes(scope: Scope) -> DataFrame:
    c = scope.clock
    cur = F.col("date") >= date_lit(c.ago(hours=24))
    prev = (F.col("date") >= date_lit(c.ago(days=8))) & (F.col("date") < date_lit(c.ago(days=1)))
    per_campaign = (scope.funnel
                    .groupBy("campaign_id", "page")
                    .agg(F.sum(F.when(cur, F.col("users"))).alias("_cur"),
                         F.sum(F.when(prev, F.col("users"))).alias("_prev")))
    return scope.per_vertical(per_campaign, ["page"],
                              [F.sum("_cur").cast("long").alias("successful_24h_count"),
                               F.sum("_prev").cast("long").alias("last_week_successful")])


def by_page(scope: Scope) -> DataFrame:
    """Started and successful counts of both windows per (vertical_name, page)."""
    return _started(scope).join(_successes(scope), ["vertical_name", "page"], "left")


def started_24h(scope: Scope) -> DataFrame:
    """L1: (vertical_name, page, total_started)."""
    return _started(scope).where(F.col("total_started").isNotNull()).select("vertical_name", "page", "total_started")


def success_24h(scope: Scope) -> DataFrame:
    """L2: (vertical_name, page, successful_24h_count) from the loader step since yesterday's date."""
    return (_successes(scope).where(F.col("successful_24h_count").isNotNull())
            .select("vertical_name", "page", "successful_24h_count"))


def _current_columns() -> list:
    """total_started, successful_24h_count, total_abandoned (clamped at 0), current_rate."""
    successful = F.coalesce("successful_24h_count", F.lit(0).cast("long"))
    abandoned = F.greatest(F.col("total_started") - successful, F.lit(0).cast("long"))
    return [F.col("total_started"), successful.alias("successful_24h_count"), abandoned.alias("total_abandoned"),
            F.when(F.col("total_started") == 0, F.lit(0.0))
            .otherwise(abandoned / F.col("total_started")).alias("current_rate")]


def _previous_columns() -> list:
    """last_week_started, last_week_successful, last_week_abandoned (not clamped), last_week_rate."""
    successful = F.coalesce("last_week_successful", F.lit(0).cast("long"))
    abandoned = F.col("last_week_started") - successful
    return [F.col("last_week_started"), successful.alias("last_week_successful"),
            abandoned.alias("last_week_abandoned"),
            F.when(F.col("last_week_started") == 0, F.lit(0.0))
            .otherwise(abandoned / F.col("last_week_started")).alias("last_week_rate")]


def abandonment_24h(scope: Scope) -> DataFrame:
    """L3: current abandonment rate per page; abandoned sessions clamped at 0."""
    return (by_page(scope).where(F.col("total_started").isNotNull())
            .select("vertical_name", "page", *_current_columns()))


def abandonment_prev_week(scope: Scope) -> DataFrame:
    """L4: the same for [now-8d, now-1d), not clamped (so the rate may be negative)."""
    return (by_page(scope).where(F.col("last_week_started").isNotNull())
            .select("vertical_name", "page", *_previous_columns()))


def both_windows(scope: Scope) -> DataFrame:
    """L3 and L4 side by side from one plan; ``cur_row``/``prev_row`` flag the windows that had sessions."""
    return by_page(scope).select(
        "vertical_name", "page", *_current_columns(), *_previous_columns()[1:],
        F.col("total_started").isNotNull().alias("cur_row"),
        F.col("last_week_started").isNotNull().alias("prev_row"))


_CURRENT = ("vertical_name", "page", "total_started", "successful_24h_count", "total_abandoned", "current_rate")


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("current_rate") > eff) & (F.col("total_started") >= p.min_sessions_for_lp_abandonment))


def _benchmark(p) -> Column:
    return F.col("last_week_rate") * p.lp_abandonment_benchmark_factor


def _automated_fired(p) -> Column:
    return fired((F.col("current_rate") > _benchmark(p))
                 & (F.col("total_started") >= p.min_sessions_for_lp_abandonment)
                 & (F.col("last_week_rate") > 0))


def _automated_row() -> Column:
    return F.col("cur_row") & F.col("prev_row")


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """Pages whose rate exceeds the fixed threshold, with at least the minimum sessions."""
    return (scope.rows("page_metrics", (HIGH_LP_ABANDONMENT,)).where("cur_row").join(thresholds, "vertical_name", "left")
            .select(*_CURRENT, "base_threshold", "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """Pages whose rate exceeds last week's times the factor (last week's rate > 0)."""
    p = scope.params
    return (scope.rows("page_metrics", (HIGH_LP_ABANDONMENT,)).where(_automated_row())
            .select(*_CURRENT, "last_week_rate", _benchmark(p).alias("benchmark"), _automated_fired(p).alias("fired")))


def branches(p) -> dict:
    """Alert branches over page_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return F.col("cur_row") & _controlled_fired(p, eff), record(
            HIGH_LP_ABANDONMENT, landing_page="page", value="current_rate", value_timeframe=LABEL_LAST_24_HOURS,
            benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED, base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_row() & _automated_fired(p), record(
            HIGH_LP_ABANDONMENT, landing_page="page", value="current_rate", value_timeframe=LABEL_LAST_24_HOURS,
            benchmark=_benchmark(p),
            benchmark_timeframe=LABEL_LAST_WEEK_RATE.format(factor=p.lp_abandonment_benchmark_factor))
    return {CONTROLLED: ctrl, AUTOMATED: auto}
