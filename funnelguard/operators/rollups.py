"""Per-campaign rollups of the fact tables: what the checks read instead of fact rows.

Rows are grouped by campaign and a *split-hour* bucket of their time:
each clock hour ``[H, H+1h)`` is cut at ``as_of``'s offset within the hour
into ``[H, H+o)`` and ``[H+o, H+1h)``. Every window of the checks starts
and ends either on a clock hour (midnight, the as_of hour of past days)
or at a whole number of hours before ``as_of``, so no window boundary ever
falls inside a bucket and a window test on the bucket start is exact.
Hour of day, weekday and the highCPA history bucket are functions of the
bucket as well. A rollup is at most two rows per campaign and hour,
whatever the fact volume, so a hot campaign costs one partial aggregate
per map task and nothing more downstream.

A session counts by several clocks: its start, its conversion, the time it
was seen. ``multi_clock`` reads the sessions once for all of them: a row
becomes a tagged row for each clock whose window holds it, and one
aggregate groups all kinds.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timewin import Clock, epoch_micros, epoch_seconds, in_dates, in_window, micros, ts_lit, utc_date
from ..params import Params
from ..sources.facts import Facts

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
HISTORY_DAYS = 28
RECENT_DAYS = 8


def split_hour_bucket(df: DataFrame, name: str, offset_us: int) -> Column:
    """Start (epoch micros) of the split-hour bucket holding ``name``."""
    us = epoch_micros(df, name)
    hour = us - F.pmod(us, F.lit(HOUR_US))
    if offset_us == 0:
        return hour
    return F.when(us - hour >= F.lit(offset_us), hour + F.lit(offset_us)).otherwise(hour)


def recent_and_weekday(clock: Clock) -> list[tuple[datetime, datetime]]:
    """The time that the checks look at: the last 8 days, and as_of's weekday in the rest of the last 28."""
    ranges = [(clock.ago(days=RECENT_DAYS), clock.now)]
    for weeks in range(2, HISTORY_DAYS // 7 + 1):
        day = clock.days_before_today(7 * weeks)
        ranges.append((max(day, clock.ago(days=HISTORY_DAYS)), day + timedelta(days=1)))
    return ranges


def in_ranges(df: DataFrame, name: str, ranges: list[tuple[datetime, datetime]]) -> Column:
    """``df[name]`` in one of the ranges, on the raw column: an OR that the scan can use."""
    conds = [in_window(df, name, lo, hi) for lo, hi in ranges]
    out = conds[0]
    for cond in conds[1:]:
        out = out | cond
    return out


def hourly_rollup(facts: Facts, clock: Clock, params: Params) -> DataFrame:
    """(campaign_id, b, n, spend, clicks) over :func:`recent_and_weekday`."""
    h = facts.hourly
    return (h.where(in_ranges(h, "timestamp", recent_and_weekday(clock)))
            .groupBy("campaign_id", split_hour_bucket(h, "timestamp", clock.offset_us).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("spend").alias("spend"),
                 F.sum("clicks").alias("clicks")))


# Kinds of tagged rows made of a session, and the column whose time counts for each.
CONVERSION, START, CLICKOUT, SEEN, SECOND = "conversion", "start", "clickout", "seen", "second"
CLOCKS = {CONVERSION: "conversion_dt", START: "session_dt", CLICKOUT: "session_dt", SEEN: "timestamp", SECOND: "conversion_dt"}
#: What else a kind is grouped by, next to campaign and bucket.
EXTRA_KEY = {START: "page", CLICKOUT: "session_id", SEEN: "vertical", SECOND: "second"}
KEYS = ("page", "session_id", "vertical", "second")


def multi_clock(sessions: DataFrame, windows: dict[str, list[tuple[datetime, datetime]]], bucket) -> DataFrame:
    """The tagged rollup of the kinds in ``windows``, from one scan and one aggregate.

    ``windows`` has the time ranges of each kind, ``bucket(df, kind, column)`` the start (epoch micros) of the bucket
    of a row. Returns (kind, campaign_id, b, page, session_id, vertical, second, n, n_sid, n_hit, n_hit_sid,
    payout, last_us); keys that a kind does not have are NULL. A hit is a payout for conversions, a postback else.
    Click-outs have a row for each session and bucket, seconds one for each second; all other kinds are as small as
    a rollup.
    """
    s = sessions
    tagged = []
    for kind, ranges in windows.items():
        column = CLOCKS[kind]
        hit = F.col("conversion_payout" if kind in (CONVERSION, SECOND) else "postback_id").isNotNull()
        values = {"page": F.col("page"), "session_id": F.col("session_id"), "vertical": F.col("vertical"),
                  "second": epoch_seconds(s, "conversion_dt")}
        keys = [(values[k] if EXTRA_KEY.get(kind) == k else F.lit(None).cast(s.schema[k].dataType if k != "second" else "long")).alias(k)
                for k in KEYS]
        cond = in_ranges(s, column, ranges)
        if kind == CLICKOUT:
            cond = cond & hit
        tagged.append(F.when(cond, F.struct(F.lit(kind).alias("kind"), bucket(s, kind, column).alias("b"), *keys, hit.alias("hit"),
                                            epoch_micros(s, column).alias("us"))))
    # any of the windows, as an OR of ranges of raw columns for the scan
    by_column = {c: [r for k, ranges in windows.items() if CLOCKS[k] == c for r in ranges] for c in dict.fromkeys(map(CLOCKS.get, windows))}
    wanted = None
    for column, ranges in by_column.items():
        cond = in_ranges(s, column, list(dict.fromkeys(ranges)))
        wanted = cond if wanted is None else wanted | cond
    rows = s.where(wanted).select("campaign_id", F.col("session_id").alias("_sid"), F.col("conversion_payout").alias("_payout"),
                                  F.explode(F.array_compact(F.array(*tagged))).alias("t"))
    flat = rows.select("campaign_id", "_sid", "_payout", "t.*")
    return flat.groupBy("kind", "campaign_id", "b", *KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count("_sid").alias("n_sid"),
        F.count(F.when(F.col("hit"), F.lit(1))).alias("n_hit"), F.count(F.when(F.col("hit"), F.col("_sid"))).alias("n_hit_sid"),
        F.sum(F.when(F.col("kind") == CONVERSION, F.col("_payout"))).alias("payout"), F.max("us").alias("last_us"))


def session_windows(clock: Clock) -> dict[str, list[tuple[datetime, datetime]]]:
    """The ranges that an evaluation at ``clock`` reads of each kind."""
    week = [(clock.ago(days=RECENT_DAYS), clock.now)]
    return {CONVERSION: recent_and_weekday(clock), START: week, CLICKOUT: week}


def session_rollups(facts: Facts, clock: Clock, kinds) -> DataFrame:
    """``multi_clock`` of the given kinds for one evaluation; a click-out's bucket is the start of its window.

    Click-outs fall into [now-24h, now) and [now-8d, now-1d), so that a session counts once in each.
    """
    recent = clock.ago(days=1)

    def bucket(df: DataFrame, kind: str, column: str) -> Column:
        if kind == CLICKOUT:
            return F.when(F.col(column) >= ts_lit(recent, df.schema[column].dataType), F.lit(micros(recent))).otherwise(
                F.lit(micros(clock.ago(days=RECENT_DAYS))))
        return split_hour_bucket(df, column, clock.offset_us)

    windows = session_windows(clock)
    return multi_clock(facts.sessions, {k: windows[k] for k in kinds}, bucket)


def conversions_of(tagged: DataFrame) -> DataFrame:
    """(campaign_id, b, n, n_sid, n_paid, n_paid_sid, payout, last_us) by conversion time."""
    return tagged.where(F.col("kind") == CONVERSION).select(
        "campaign_id", "b", "n", "n_sid", F.col("n_hit").alias("n_paid"), F.col("n_hit_sid").alias("n_paid_sid"), "payout", "last_us")


def sessions_of(tagged: DataFrame) -> DataFrame:
    """(campaign_id, page, b, n, n_sid, n_out, n_out_sid) by session start."""
    return tagged.where(F.col("kind") == START).select(
        "campaign_id", "page", "b", "n", "n_sid", F.col("n_hit").alias("n_out"), F.col("n_hit_sid").alias("n_out_sid"))


def clickouts_of(tagged: DataFrame, clock: Clock) -> DataFrame:
    """Distinct click-out sessions per campaign for [now-24h, now) and [now-8d, now-1d).

    (campaign_id, current_clickouts, has_current, last_week_clickouts, has_last_week). Rows are already one per
    campaign, session and window, which spread a hot campaign over as many keys as it has sessions.
    """
    recent = F.col("b") >= F.lit(micros(clock.ago(days=1)))
    return (tagged.where(F.col("kind") == CLICKOUT).groupBy("campaign_id")
            .agg(F.count(F.when(recent, F.col("session_id"))).alias("current_clickouts"),
                 F.max(recent).alias("has_current"),
                 F.count(F.when(~recent, F.col("session_id"))).alias("last_week_clickouts"),
                 F.max(~recent).alias("has_last_week")))


def distinct_in_windows(tagged: DataFrame, clock: Clock) -> DataFrame:
    """The click-out rows of a finer rollup as one row for each campaign, session and window, as ``clickouts_of`` reads them."""
    recent = F.lit(micros(clock.ago(days=1)))
    window = F.when(F.col("b") >= recent, recent).otherwise(F.lit(micros(clock.ago(days=RECENT_DAYS))))
    return (tagged.where((F.col("kind") == CLICKOUT) & (F.col("b") >= F.lit(micros(clock.ago(days=RECENT_DAYS)))))
            .select("kind", "campaign_id", "session_id", window.alias("b")).distinct())


def bitmap_clickouts(sessions: DataFrame, clock: Clock) -> DataFrame:
    """``clickouts_of`` by bitmaps of session numbers: (campaign, range of 32,768 numbers) rows, no session is shuffled.

    Exact for integer ids of any sign. Worth it where a campaign has many sessions in each range of numbers; a bitmap is
    4 KB in memory, however few bits it has, so that ``clickouts_of`` stays the default, and the way for text ids.
    """
    if not isinstance(sessions.schema["session_id"].dataType, T.IntegralType):
        raise ValueError("bitmaps need integer session ids")
    split, lo = clock.ago(days=1), clock.ago(days=RECENT_DAYS)
    recent = F.coalesce(in_window(sessions, "session_dt", split, None), F.lit(False)).alias("recent")
    number = F.col("session_id").cast("long")
    maps = (sessions.where(in_window(sessions, "session_dt", lo, clock.now) & F.col("postback_id").isNotNull())
            .groupBy("campaign_id", recent, F.bitmap_bucket_number(number).alias("_range"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")))
    return bitmap_counts(maps)


def bitmap_counts(maps: DataFrame) -> DataFrame:
    """(campaign_id, current_clickouts, ...) of bitmaps (campaign_id, recent, _range, _bits), which may repeat a range."""
    merged = maps.groupBy("campaign_id", "recent", "_range").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    return merged.groupBy("campaign_id").agg(
        # a range number is NULL for rows without a session id: they count as rows, not as sessions
        F.coalesce(F.sum(F.when(F.col("recent") & F.col("_range").isNotNull(), F.col("_n"))), F.lit(0)).cast("long").alias("current_clickouts"),
        F.max("recent").alias("has_current"),
        F.coalesce(F.sum(F.when(~F.col("recent") & F.col("_range").isNotNull(), F.col("_n"))), F.lit(0)).cast("long").alias("last_week_clickouts"),
        F.max(~F.col("recent")).alias("has_last_week"))


def older_conversions(facts: Facts, clock: Clock, campaigns: DataFrame) -> DataFrame:
    """(campaign_id, last_us): latest conversion before the rollup's 28 days, of the given campaigns only.

    ``campaigns`` holds those whose vertical has none in the rollup; when it
    is empty, adaptive execution drops the scan.
    """
    s = facts.sessions
    return (s.where(in_window(s, "conversion_dt", None, clock.ago(days=HISTORY_DAYS)))
            .join(campaigns, "campaign_id", "left_semi")
            .groupBy("campaign_id").agg(F.max(epoch_micros(s, "conversion_dt")).alias("last_us")))


def conversion_seconds(facts: Facts, clock: Clock, pairs: DataFrame) -> DataFrame:
    """(vertical_name, s, n, last_us): conversions per vertical and whole second in [as_of - 28 days, midnight of as_of).

    The vertical is attached below the aggregate (``pairs`` is broadcast where it measures small), so that map tasks
    combine by vertical and second: the shuffle has at most the 2.4 million seconds of four weeks for each vertical
    and map task, not the conversions of each campaign.
    """
    s = facts.sessions
    return (s.where(in_window(s, "conversion_dt", clock.ago(days=HISTORY_DAYS), clock.today))
            .select("campaign_id", epoch_seconds(s, "conversion_dt").alias("s"), epoch_micros(s, "conversion_dt").alias("us"))
            .join(pairs, "campaign_id")
            .groupBy("vertical_name", "s").agg(F.count(F.lit(1)).alias("n"), F.max("us").alias("last_us")))


def daily_spend_rollup(facts: Facts, clock: Clock, params: Params) -> DataFrame:
    """(campaign_id, date, spend) for the as_of date and the 7 days before it."""
    d = facts.daily
    return (d.where(in_dates(d, "date", clock.days_before_today(7), clock.today_date))
            .groupBy("campaign_id", utc_date(d, "date").alias("date"))
            .agg(F.sum("spend").alias("spend")))


def funnel_rollup(facts: Facts, clock: Clock, loader_step: str) -> DataFrame:
    """(campaign_id, page, date, users) of the loader step from date(as_of - 8 days) to the as_of date."""
    f = facts.funnel
    return (f.where((F.col("interaction_type") == loader_step)
                    & in_dates(f, "date", clock.ago(days=8), clock.today_date))
            .groupBy("campaign_id", "page", utc_date(f, "date").alias("date"))
            .agg(F.sum("users_reached_step").alias("users")))


def hour_start(col: str = "b") -> Column:
    """Clock hour (epoch micros) that a bucket start falls in."""
    return F.col(col) - F.pmod(F.col(col), F.lit(HOUR_US))


def weekday(col: str = "b") -> Column:
    """Spark's day-of-week numbering (1 = Sunday) of a UTC epoch-micros value."""
    return F.pmod(F.floor(F.col(col) / F.lit(DAY_US)) + 4, 7) + 1
