"""Small hand-made fact tables for edge-case tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import types as T

from funnelguard.sources.config import config_frame
from funnelguard.sources.facts import DAILY, FUNNEL, HOURLY, SESSIONS, facts_from_frames

TS = T.TimestampNTZType()

HOURLY_SCHEMA = T.StructType([
    T.StructField("campaign_id", T.StringType()), T.StructField("campaign_name", T.StringType()),
    T.StructField("vertical", T.StringType()), T.StructField("timestamp", TS),
    T.StructField("spend", T.DoubleType()), T.StructField("clicks", T.LongType())])
DAILY_SCHEMA = T.StructType([
    T.StructField("campaign_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("spend", T.DoubleType())])
SESSIONS_SCHEMA = T.StructType([
    T.StructField("session_id", T.LongType()), T.StructField("campaign_id", T.StringType()),
    T.StructField("vertical", T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("timestamp", TS), T.StructField("session_dt", TS),
    T.StructField("postback_id", T.StringType()), T.StructField("conversion_dt", TS),
    T.StructField("conversion_payout", T.DoubleType())])
FUNNEL_SCHEMA = T.StructType([
    T.StructField("campaign_id", T.StringType()), T.StructField("page", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("interaction_type", T.StringType()),
    T.StructField("users_reached_step", T.LongType())])

AS_OF = datetime(2024, 1, 30, 15, 0, 0)


def hourly(campaign="c1", at=AS_OF - timedelta(hours=1), spend=10.0, clicks=10, name="Camp 1", vertical="v"):
    return (campaign, name, vertical, at, spend, clicks)


def daily(campaign="c1", day=AS_OF.date(), spend=10.0):
    return (campaign, day, spend)


def session(sid=1, campaign="c1", at=AS_OF - timedelta(hours=1), page="/p", postback=None, conversion=None,
            payout=None, vertical="v"):
    return (sid, campaign, vertical, page, at, at, postback, conversion, payout)


def funnel(campaign="c1", page="/p", day=AS_OF.date(), step="loader", users=1):
    return (campaign, page, day if isinstance(day, date) else day.date(), step, users)


def make_facts(spark, hourly_rows=(), daily_rows=(), session_rows=(), funnel_rows=()):
    frames = {
        HOURLY: spark.createDataFrame(list(hourly_rows), HOURLY_SCHEMA),
        DAILY: spark.createDataFrame(list(daily_rows), DAILY_SCHEMA),
        SESSIONS: spark.createDataFrame(list(session_rows), SESSIONS_SCHEMA),
        FUNNEL: spark.createDataFrame(list(funnel_rows), FUNNEL_SCHEMA),
    }
    return facts_from_frames(frames)


def config(spark, vertical="v", **alerts):
    return config_frame(spark, [{"vertical_name": vertical, "alerts": alerts}])
