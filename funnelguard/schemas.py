"""Declared input and output schemas, and the fixed labels of alert records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TS = (T.TimestampType, T.TimestampNTZType)
NUM = (T.DoubleType, T.FloatType, T.DecimalType, T.LongType, T.IntegerType, T.ShortType)
INT = (T.LongType, T.IntegerType, T.ShortType)
STR = (T.StringType,)
DATE = (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)

# Required columns per fact table and the type families each may have.
FACT_COLUMNS: dict[str, dict[str, tuple]] = {
    "hourly_ad_performance_metrics": {
        "campaign_id": STR, "campaign_name": STR, "vertical": STR,
        "timestamp": TS, "spend": NUM, "clicks": INT,
    },
    "daily_ad_performance_metrics": {
        "campaign_id": STR, "date": DATE, "spend": NUM,
    },
    "sessions_full_lifecycle": {
        "session_id": STR + INT, "campaign_id": STR, "vertical": STR, "page": STR,
        "timestamp": TS, "session_dt": TS, "postback_id": STR,
        "conversion_dt": TS, "conversion_payout": NUM,
    },
    "daily_actions_funnel": {
        "campaign_id": STR, "page": STR, "date": DATE,
        "interaction_type": STR, "users_reached_step": INT,
    },
}

ALERT_SETTINGS = T.StructType([
    T.StructField("globalBaseThreshold", T.DoubleType()),
    T.StructField("globalPercent", T.DoubleType()),
    T.StructField("automated", T.BooleanType()),
])

ALERT_CONFIG = T.StructType([
    T.StructField("vertical_name", T.StringType()),
    T.StructField("alerts", T.MapType(T.StringType(), ALERT_SETTINGS)),
])

ALERT = T.StructType([
    T.StructField("alert_name", T.StringType(), False),
    T.StructField("vertical_name", T.StringType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("calculated_value", T.DoubleType()),
    T.StructField("calculated_value_timeframe", T.StringType()),
    T.StructField("benchmark", T.DoubleType()),
    T.StructField("benchmark_timeframe", T.StringType()),
    T.StructField("landing_page", T.StringType()),
    T.StructField("spend", T.DoubleType()),
    T.StructField("leads", T.LongType()),
    T.StructField("base_threshold", T.DoubleType()),
])

# --- Fixed values: alert names, levels and record labels (must equal the reference's) ---
VOLUME_DROP = "volumeDrop"
FLOW_INTERRUPTION = "flowInterruption"
HIGH_CPA = "highCPA"
PERFORMANCE_DECLINE = "performanceDecline"
FB_TO_CLICKOUT = "fbToClickout"
CLICKOUT_TO_CONVERSION = "clickoutToConversion"
HIGH_LP_ABANDONMENT = "highLpAbandonment"

CAMPAIGN_ALERTS = (HIGH_CPA, PERFORMANCE_DECLINE, FB_TO_CLICKOUT, CLICKOUT_TO_CONVERSION)
VERTICAL_ALERTS = (VOLUME_DROP, FLOW_INTERRUPTION, HIGH_LP_ABANDONMENT)

LABEL_LAST_1_HOUR = "Last 1 Hour"
LABEL_LAST_6_HOURS = "Last 6 Hours"
LABEL_LAST_24_HOURS = "Last 24 Hours"
LABEL_TODAY = "Today"
LABEL_MINUTES_SINCE = "Minutes since last Click-out/Lead"
LABEL_CONTROLLED = "Controlled Threshold"
LABEL_CONTROLLED_MINUTES = "Controlled Threshold (minutes)"
LABEL_SAME_HOUR_AVG = "Last 7 Days (same hour avg)"
LABEL_DYNAMIC_MINUTES = "Automated Dynamic Threshold (min)"
LABEL_WEIGHTED_MAD = "Automated Threshold (Weighted Median + MAD)"
LABEL_LAST_WEEK_ROI = "Last Week's Avg ROI * {factor}"
LABEL_LAST_WEEK_RATE = "Last Week's Avg Rate * {factor}"
LABEL_LAST_WEEK_CR = "Last Week's Avg CR * {factor}"
NOT_APPLICABLE = "N/A"
# --- End of fixed values ---


class SchemaError(ValueError):
    pass


def check_columns(df: DataFrame, table: str) -> None:
    """Raise SchemaError if a required column is missing or of the wrong type family."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, families in FACT_COLUMNS[table].items():
        if name not in fields:
            problems.append(f"missing column {name}")
        elif not isinstance(fields[name], families):
            problems.append(f"{name} has type {fields[name].simpleString()}")
    if problems:
        raise SchemaError(f"{table}: " + "; ".join(problems))
