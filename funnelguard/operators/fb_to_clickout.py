"""fbToClickout (B1-B4): ad clicks that turn into click-outs, last 24 hours against the week before.

Clicks come from the hourly rollup, click-outs are *distinct* sessions with
a postback (``rollups.clickouts_of``, from rows grouped by campaign, session
and window, which spread a hot campaign over as many shuffle keys as it has
sessions; or ``rollups.bitmap_clickouts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import any_row, fired, ratio
from ..schemas import FB_TO_CLICKOUT, LABEL_CONTROLLED, LABEL_LAST_24_HOURS, LABEL_LAST_WEEK_RATE
from .records import record
from .scope import AUTOMATED, CONTROLLED, Scope


def by_campaign(scope: Scope) -> DataFrame:
    """Clicks and distinct click-outs for [now-24h, now) and [now-8d, now-1d), per campaign."""
    c, p = scope.clock, scope.params
    cur = scope.within(c.ago(days=1), c.now)
    prev = scope.within(c.ago(days=8), c.ago(days=1))
    clicks = (scope.hourly.where(cur | prev)
              .groupBy("campaign_id")
              .agg(F.sum(F.when(cur, F.col("clicks"))).cast("long").alias("current_fb_clicks"),
                   any_row(cur).alias("_clicks_cur"),
                   F.sum(F.when(prev, F.col("clicks"))).cast("long").alias("last_week_fb_clicks"),
                   any_row(prev).alias("_clicks_prev")))
    joined = clicks.join(scope.clickouts, "campaign_id", "full")
    flag = lambda name: F.coalesce(F.col(name), F.lit(False))
    joined = joined.select(
        "campaign_id", "current_fb_clicks", "last_week_fb_clicks",
        (flag("_clicks_cur") | flag("has_current")).alias("_cur_row"),
        (flag("_clicks_prev") | flag("has_last_week")).alias("_prev_row"),
        # a side without rows in a window is NULL, as after an outer join
        F.when(F.col("has_current"), F.col("current_clickouts")).alias("current_clickouts"),
        F.when(F.col("has_last_week"), F.col("last_week_clickouts")).alias("last_week_clickouts"))
    if p.missing == "zero":
        joined = joined.fillna(0, ["current_fb_clicks", "last_week_fb_clicks", "current_clickouts",
                                   "last_week_clickouts"])
    return joined.select(
        "*",
        ratio("current_clickouts", "current_fb_clicks", 0.0).alias("current_fb_to_clickout_rate"),
        ratio("last_week_clickouts", "last_week_fb_clicks", 0.0).alias("last_week_fb_to_clickout_rate"))


def rate_24h(scope: Scope) -> DataFrame:
    """B1: (vertical_name, campaign_id, current_fb_clicks, current_clickouts, current_fb_to_clickout_rate)."""
    rows = by_campaign(scope).where("_cur_row")
    return scope.per_campaign(rows.select("campaign_id", "current_fb_clicks", "current_clickouts",
                                          "current_fb_to_clickout_rate"))


def rate_prev_week(scope: Scope) -> DataFrame:
    """B2: the same for [now-8d, now-1d)."""
    rows = by_campaign(scope).where("_prev_row")
    return scope.per_campaign(rows.select("campaign_id", "last_week_fb_clicks", "last_week_clickouts",
                                          "last_week_fb_to_clickout_rate"))


def _controlled_fired(p, eff: Column) -> Column:
    return fired((F.col("current_fb_to_clickout_rate") < eff)
                 & (F.col("current_fb_clicks") >= p.min_clicks_for_fb_to_clickout))


def _benchmark(p) -> Column:
    return F.col("last_week_fb_to_clickout_rate") * p.fb_to_clickout_drop_factor


def _automated_fired(p) -> Column:
    return fired((F.col("last_week_fb_to_clickout_rate") > 0)
                 & (F.col("current_fb_to_clickout_rate") < _benchmark(p))
                 & (F.col("current_fb_clicks") >= p.min_clicks_for_fb_to_clickout))


def _automated_row() -> Column:
    return F.col("fb_cur_row") & F.col("fb_prev_row")


def controlled(scope: Scope, thresholds: DataFrame) -> DataFrame:
    """Rate below the fixed threshold with at least the minimum clicks."""
    return (scope.rows("campaign_metrics", (FB_TO_CLICKOUT,)).where("fb_cur_row").join(thresholds, "vertical_name", "left")
            .select("vertical_name", "campaign_id", "campaign_name", "current_fb_to_clickout_rate",
                    "current_fb_clicks", "base_threshold", "effective_threshold",
                    _controlled_fired(scope.params, F.col("effective_threshold")).alias("fired")))


def automated(scope: Scope) -> DataFrame:
    """Rate below last week's rate times the drop factor (last week's rate > 0)."""
    p = scope.params
    return (scope.rows("campaign_metrics", (FB_TO_CLICKOUT,)).where(_automated_row())
            .select("campaign_id", "vertical_name", "campaign_name", "current_fb_to_clickout_rate",
                    "current_fb_clicks", "last_week_fb_to_clickout_rate", _benchmark(p).alias("benchmark"),
                    _automated_fired(p).alias("fired")))


def branches(p) -> dict:
    """Alert branches over campaign_metrics: mode -> f(base, effective) -> (fires, record)."""
    def ctrl(base: Column, eff: Column):
        return F.col("fb_cur_row") & _controlled_fired(p, eff), record(
            FB_TO_CLICKOUT, campaign=True, value="current_fb_to_clickout_rate",
            value_timeframe=LABEL_LAST_24_HOURS, benchmark=eff, benchmark_timeframe=LABEL_CONTROLLED,
            base_threshold=base)

    def auto(base: Column, eff: Column):
        return _automated_row() & _automated_fired(p), record(
            FB_TO_CLICKOUT, campaign=True, value="current_fb_to_clickout_rate",
            value_timeframe=LABEL_LAST_24_HOURS, benchmark=_benchmark(p),
            benchmark_timeframe=LABEL_LAST_WEEK_RATE.format(factor=p.fb_to_clickout_drop_factor))
    return {CONTROLLED: ctrl, AUTOMATED: auto}
