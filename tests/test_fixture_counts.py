"""Candidate / fired counts of the automated checks on the first part of the sf0.001 fixture (FIXTURES.md, Part B)."""

from __future__ import annotations

from funnelguard.plans.catalog import QUERIES, Fixture

SF = "/root/testdata/sf0.001"


def _count(fx, name):
    rows = [r for r in QUERIES[name](fx).collect() if r.vertical_name.startswith("v")]
    return len(rows), sum(bool(r.fired) for r in rows)


def test_automated_checks_match_the_fixture_table(spark):
    fx = Fixture(spark, SF)
    assert QUERIES["cpa_threshold"](fx).filter("campaign_id LIKE 'c%'").count() == 2
    assert _count(fx, "high_cpa_automated")[1] == 1
    assert _count(fx, "performance_decline_automated") == (6, 1)
    assert _count(fx, "fb_to_clickout_automated") == (6, 3)
    assert _count(fx, "clickout_to_conversion_automated")[1] == 1
    assert _count(fx, "lp_abandonment_automated") == (4, 2)
    gaps = {r.vertical_name: r.num_gaps for r in QUERIES["gap_median"](fx).filter("vertical_name LIKE 'v%'").collect()}
    assert gaps == {"v0": 77, "v1": 63, "v2": 0, "v3": 0}
