"""Clock, windows and the split-hour buckets that make rollups exact."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from funnelguard.functions.timewin import Clock, epoch_micros, micros, to_utc_naive
from funnelguard.operators.rollups import HOUR_US, hour_start, split_hour_bucket, weekday


def test_clock_parts():
    c = Clock.at("2024-01-30T15:20:05.5+02:00")
    assert c.now == datetime(2024, 1, 30, 13, 20, 5, 500000)
    assert c.today == datetime(2024, 1, 30)
    assert c.dayofweek == 3  # Tuesday, Spark numbering
    assert c.offset_us == (20 * 60 + 5) * 1_000_000 + 500_000
    assert to_utc_naive(datetime(2024, 1, 1, tzinfo=timezone.utc)) == datetime(2024, 1, 1)


def _windows(c: Clock):
    """Every window boundary pair the checks use."""
    hour_start_dt = c.today + timedelta(hours=c.hour)
    out = [(c.ago(hours=1), c.now), (c.ago(hours=6), c.now), (c.ago(hours=24), c.now),
           (c.ago(days=8), c.ago(days=1)), (c.ago(days=28), c.now), (c.today, c.now),
           (c.days_before_today(7), c.today), (c.days_before_today(7), c.days_before_today(6)),
           (c.ago(days=28), c.today)]
    out += [(hour_start_dt - timedelta(days=k), hour_start_dt - timedelta(days=k, hours=-1)) for k in range(1, 8)]
    return out


def test_split_hour_buckets_are_exact_for_every_window(spark):
    rnd = random.Random(7)
    for as_of in (datetime(2024, 1, 30, 15, 0, 0), datetime(2024, 1, 30, 15, 23, 11, 250), datetime(2024, 2, 4, 0, 0, 1)):
        c = Clock(as_of)
        stamps = []
        for lo, hi in _windows(c):
            for edge in (lo, hi):
                stamps += [edge, edge - timedelta(microseconds=1), edge + timedelta(microseconds=1)]
        stamps += [as_of - timedelta(seconds=rnd.randint(0, 30 * 86400)) for _ in range(300)]
        df = (spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz"))
        df = df.select("t", split_hour_bucket(df, "t", c.offset_us).alias("b"), epoch_micros(df, "t").alias("us"))
        rows = df.collect()
        for lo, hi in _windows(c):
            lo_us, hi_us = micros(lo), micros(hi)
            for r in rows:
                assert (lo_us <= r.us < hi_us) == (lo_us <= r.b < hi_us), (as_of, lo, hi, r.t)


def test_bucket_hour_and_weekday_match_spark(spark):
    c = Clock(datetime(2024, 1, 30, 15, 23))
    stamps = [datetime(2024, 1, 1) + timedelta(minutes=37 * i) for i in range(2000)]
    df = (spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz"))
    df = df.withColumn("b", split_hour_bucket(df, "t", c.offset_us))
    bad = df.where((F.dayofweek("t") != weekday()) | (F.hour("t") * F.lit(HOUR_US) != F.pmod(hour_start(), 24 * HOUR_US)))
    assert bad.count() == 0
