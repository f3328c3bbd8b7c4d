"""Registered queries against the DuckDB oracle on the smallest scale (the driver checks sf0.01)."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TYPE_NAMES = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
SUBSET = ("alerts_all", "alert_payload_json", "alert_config", "scope_to_active", "last_conversion", "active_campaigns", "alert_modes", "same_hour_7d_avg", "conversion_gaps", "gap_median",
          "cpa_history", "cpa_trimmed", "cpa_threshold", "high_cpa_controlled", "roi_today",
          "clickout_rate_prev_week", "clickout_rate_prev_week_bitmaps", "rollup_store_rows", "alerts_all_incremental", "conversion_rate_week_ago", "lp_abandonment_automated")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{Path(SF) / 'events.parquet'}')")
    return c


def _rows(values):
    def norm(v):
        return ("nan",) if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(v) for v in r) for r in values), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for field in df.schema.fields:
        assert TYPE_NAMES[field.dataType.simpleString()] == duck_types[field.name], field
    order = [rel.columns.index(c) for c in df.columns]
    expect = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert _rows(df.collect()) == _rows(expect)


def test_every_alert_query_has_an_oracle():
    from funnelguard.plans.catalog import QUERIES

    assert set(QUERIES) <= set(oracle_sql()) & set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert [f.name for f in df.schema.fields][:2] == ["alert_name", "vertical_name"]
    assert df.count() >= 0
