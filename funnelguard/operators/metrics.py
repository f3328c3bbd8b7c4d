"""Wide metric tables: every current and benchmark value at the grain it is checked at.

The rollups become three small tables (one row per active campaign, per
vertical, per landing page) that hold what the wanted alerts need, and only
that. Both branches of a check (fixed threshold and learned benchmark) read
the same table, so the alert plan is a handful of filters and projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import (CAMPAIGN_ALERTS, CLICKOUT_TO_CONVERSION, FB_TO_CLICKOUT, FLOW_INTERRUPTION, HIGH_CPA,
                       HIGH_LP_ABANDONMENT, PERFORMANCE_DECLINE, VOLUME_DROP)
from . import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa, lp_abandonment,
               performance_decline, volume_drop)


#: Metric table -> its alerts, and alert -> the inputs of a Scope that it reads.
TABLES = {"campaign_metrics": CAMPAIGN_ALERTS, "vertical_metrics": (VOLUME_DROP, FLOW_INTERRUPTION),
          "page_metrics": (HIGH_LP_ABANDONMENT,)}
INPUTS = {
    HIGH_CPA: ("hourly", "conversions"),
    PERFORMANCE_DECLINE: ("conversions", "daily_spend"),
    FB_TO_CLICKOUT: ("hourly", "clickouts"),
    CLICKOUT_TO_CONVERSION: ("conversions", "sessions"),
    VOLUME_DROP: ("hourly", "conversions"),
    FLOW_INTERRUPTION: ("hourly", "conversions", "conversion_segments"),
    HIGH_LP_ABANDONMENT: ("sessions", "funnel"),
}


def tables_of(alerts) -> list[str]:
    return [table for table, own in TABLES.items() if any(a in alerts for a in own)]


def campaign_metrics(scope, alerts) -> DataFrame:
    """(vertical_name, campaign_id, campaign_name, ...) for every active campaign, with the columns of ``alerts``.

    Flag columns keep "this window had rows" apart from "the value is NULL":
    ``cpa_present``, ``roi_today_row``/``roi_week_row``,
    ``fb_cur_row``/``fb_prev_row``, ``cr_today_row``/``cr_week_row``.
    """
    parts, flags = [], []
    if HIGH_CPA in alerts:
        parts += [high_cpa.current_by_campaign(scope).withColumn("cpa_present", F.lit(True)), high_cpa.benchmark(scope)]
        flags += ["cpa_present"]
    if PERFORMANCE_DECLINE in alerts:
        parts.append(performance_decline.by_campaign(scope).select(
            "campaign_id", "todays_roi", "todays_spend", "last_week_roi", "last_week_spend",
            F.col("_today").alias("roi_today_row"), F.col("_week").alias("roi_week_row")))
        flags += ["roi_today_row", "roi_week_row"]
    if FB_TO_CLICKOUT in alerts:
        parts.append(fb_to_clickout.by_campaign(scope).select(
            "campaign_id", "current_fb_clicks", "current_fb_to_clickout_rate", "last_week_fb_to_clickout_rate",
            F.col("_cur_row").alias("fb_cur_row"), F.col("_prev_row").alias("fb_prev_row")))
        flags += ["fb_cur_row", "fb_prev_row"]
    if CLICKOUT_TO_CONVERSION in alerts:
        parts.append(clickout_to_conversion.by_campaign(scope).select(
            "campaign_id", "todays_cr", "todays_clickouts", "last_week_cr",
            F.col("_today").alias("cr_today_row"), F.col("_week").alias("cr_week_row")))
        flags += ["cr_today_row", "cr_week_row"]
    out = scope.active
    for part in parts:
        out = out.join(part, "campaign_id", "left")
    return out.fillna(False, flags)


def vertical_metrics(scope, alerts) -> DataFrame:
    """One row per active or configured vertical: spend today and, as ``alerts`` need, volumes, minutes since and gaps."""
    out = volume_drop.spend_today(scope)
    if VOLUME_DROP in alerts:
        out = out.join(volume_drop.volumes(scope), "vertical_name", "left")
    if FLOW_INTERRUPTION in alerts:
        out = (out.join(flow_interruption.minutes_since_conversion(scope), "vertical_name", "left")
               .join(flow_interruption.gap_threshold(scope), "vertical_name", "left"))
    return out


def page_metrics(scope, alerts) -> DataFrame:
    """One row per (vertical, page) with sessions in either window; ``cur_row``/``prev_row`` say which."""
    return lp_abandonment.both_windows(scope)
