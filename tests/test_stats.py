"""Robust statistics against plain-Python brute force, many random groups per Spark job."""

from __future__ import annotations

import math
import random

from funnelguard.functions.stats import consecutive_gaps, percentile_trim, weighted_mad, weighted_median


def py_weighted_median(pairs):
    """Smallest value whose cumulative weight (ascending) reaches half of the total."""
    pairs = sorted(pairs)
    half = sum(w for _, w in pairs) / 2.0
    cum = 0
    for v, w in pairs:
        cum += w
        if cum >= half:
            return v
    return None


def _groups(seed, n_groups=120, max_rows=40, ties=False):
    rnd = random.Random(seed)
    rows = []
    for g in range(n_groups):
        for _ in range(rnd.randint(1, max_rows)):
            v = float(rnd.randint(0, 6)) if ties else round(rnd.uniform(0, 50), 3)
            rows.append((g, v, rnd.randint(1, 9)))
    return rows


def test_weighted_median_hand_cases(spark):
    rows = [("a", 1.0, 1), ("a", 2.0, 1), ("a", 3.0, 2),   # half reached exactly at 2
            ("b", 1.0, 2), ("b", 2.0, 1), ("b", 3.0, 1),   # first row already holds half
            ("c", 7.0, 5)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    got = {r.k: r.m for r in weighted_median(df, ["k"], "v", "w", "m").collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": 7.0}


def test_weighted_median_matches_brute_force(spark):
    for seed, ties in ((1, False), (2, True)):
        rows = _groups(seed, ties=ties)
        df = spark.createDataFrame(rows, "g long, v double, w long")
        got = {r.g: r.m for r in weighted_median(df, ["g"], "v", "w", "m").collect()}
        by_group = {}
        for g, v, w in rows:
            by_group.setdefault(g, []).append((v, w))
        assert got == {g: py_weighted_median(p) for g, p in by_group.items()}


def test_unit_weights_give_lower_median(spark):
    rows = [(0, float(v), 1) for v in (5, 1, 4, 2)] + [(1, float(v), 1) for v in (3, 9, 1)]
    df = spark.createDataFrame(rows, "g long, v double, w long")
    got = {r.g: r.m for r in weighted_median(df, ["g"], "v", "w", "m").collect()}
    assert got == {0: 2.0, 1: 3.0}


def test_weighted_mad_matches_brute_force_and_laws(spark):
    rows = _groups(3, n_groups=60)
    df = spark.createDataFrame(rows, "g long, v double, w long")
    med = weighted_median(df, ["g"], "v", "w", "m")
    mad = {r.g: r.d for r in weighted_mad(df, med, ["g"], "v", "w", "m", "d").collect()}
    by_group = {}
    for g, v, w in rows:
        by_group.setdefault(g, []).append((v, w))
    for g, pairs in by_group.items():
        m = py_weighted_median(pairs)
        assert math.isclose(mad[g], py_weighted_median([(abs(v - m), w) for v, w in pairs]), abs_tol=1e-9)

    # shifting all values leaves the MAD unchanged; scaling by 2 doubles it
    shifted = df.selectExpr("g", "v + 100 as v", "w")
    scaled = df.selectExpr("g", "v * 2 as v", "w")
    for frame, expect in ((shifted, lambda x: x), (scaled, lambda x: 2 * x)):
        m2 = weighted_median(frame, ["g"], "v", "w", "m")
        got = {r.g: r.d for r in weighted_mad(frame, m2, ["g"], "v", "w", "m", "d").collect()}
        for g in by_group:
            assert math.isclose(got[g], expect(mad[g]), rel_tol=1e-9, abs_tol=1e-9)


def test_single_bucket_has_zero_mad(spark):
    df = spark.createDataFrame([(0, 12.5, 3)], "g long, v double, w long")
    med = weighted_median(df, ["g"], "v", "w", "m")
    assert weighted_mad(df, med, ["g"], "v", "w", "m", "d").first().d == 0.0


def test_percentile_trim_keeps_inclusive_band(spark):
    rows = [(g, v, 1) for g, v, _ in _groups(4, n_groups=50, max_rows=60)]
    df = spark.createDataFrame(rows, "g long, v double, w long")
    kept = percentile_trim(df, ["g"], "v", 0.1, 0.9, 1000)
    got = sorted((r.g, r.v) for r in kept.collect())
    expect = []
    by_group = {}
    for g, v, _ in rows:
        by_group.setdefault(g, []).append(v)
    for g, values in by_group.items():
        s = sorted(values)
        n = len(s)
        lo, hi = s[max(math.ceil(0.1 * n), 1) - 1], s[max(math.ceil(0.9 * n), 1) - 1]
        expect += [(g, v) for v in values if lo <= v <= hi]
    assert got == sorted(expect)


def test_sliced_gaps_equal_plain_lag(spark):
    rnd = random.Random(5)
    base = 1_706_000_000
    rows = []
    for key in ("a", "b", "c"):
        t = base
        for _ in range(rnd.randint(1, 400)):
            t += rnd.choice([0, 1, 7, 59, 600, 3599, 3600, 7300, 50_000])
            rows.append((key, t + rnd.random()))
    df = spark.createDataFrame(rows, "k string, s double").selectExpr("k", "cast(floor(s) as bigint) as s").groupBy("k", "s").count()
    expect = {}
    for key in ("a", "b", "c"):
        secs = sorted(math.floor(s) for k, s in rows if k == key)
        expect[key] = sorted(b - a for a, b in zip(secs, secs[1:]))
    for slice_seconds in (60, 3600, 86_400 * 30):
        got = {}
        for r in consecutive_gaps(df, ["k"], "s", "count", slice_seconds, "gap").collect():
            got.setdefault(r.k, []).extend([r.gap] * r.n)
        assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expect.items() if v}
