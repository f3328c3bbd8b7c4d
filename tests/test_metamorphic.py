"""Metamorphic properties: rows at or after as_of change nothing; other campaigns change nothing."""

from __future__ import annotations

from datetime import timedelta

from factories import (AS_OF, DAILY_SCHEMA, FUNNEL_SCHEMA, HOURLY_SCHEMA, SESSIONS_SCHEMA, daily, funnel, hourly,
                       session)
from pyspark.sql import functions as F

from funnelguard.operators import metrics
from funnelguard.operators.scope import Scope
from funnelguard.plans.catalog import QUERIES
from funnelguard.plans.oracle import oracle_sql
from funnelguard.sources import fixture
from funnelguard.sources.facts import Facts

SF = "/root/testdata/sf0.001"


def _append(spark, df, rows, schema):
    extra = spark.createDataFrame(rows, schema)
    return df.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields]))


def _metrics(facts):
    scope = Scope.build(facts, fixture.AS_OF)
    out = {}
    for name, alerts in metrics.TABLES.items():
        df = scope.rows(name, alerts)
        out[name] = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
    return out


def test_future_rows_change_nothing(spark):
    base = fixture.fixture_facts(spark, SF)
    later = [AS_OF, AS_OF + timedelta(minutes=5), AS_OF + timedelta(days=2)]
    grown = Facts(
        hourly=_append(spark, base.hourly, [hourly(f"c{i}", at=t, spend=999.0, vertical=f"v{i % 2}")
                                            for i in range(6) for t in later], HOURLY_SCHEMA),
        daily=_append(spark, base.daily, [daily(f"c{i}", day=AS_OF.date() + timedelta(days=1), spend=5.0)
                                          for i in range(6)], DAILY_SCHEMA),
        sessions=_append(spark, base.sessions, [session(10_000 + i, f"c{i}", at=t, postback="x", conversion=t,
                                                        payout=3.0, vertical=f"v{i % 2}", page=f"/lp/{i % 4}")
                                                for i in range(6) for t in later], SESSIONS_SCHEMA),
        funnel=_append(spark, base.funnel, [funnel(f"c{i}", page=f"/lp/{i % 4}",
                                                   day=AS_OF.date() + timedelta(days=1), users=50)
                                            for i in range(6)], FUNNEL_SCHEMA),
    )
    assert _metrics(base) == _metrics(grown)


def test_inactive_campaign_changes_no_other(spark):
    base = fixture.fixture_facts(spark, SF)
    old = AS_OF - timedelta(days=3)
    grown = Facts(
        hourly=_append(spark, base.hourly, [hourly("zz", at=old, spend=500.0, vertical="v0")], HOURLY_SCHEMA),
        daily=base.daily,
        sessions=_append(spark, base.sessions, [session(99_999, "zz", at=old, postback="y", conversion=old,
                                                        payout=1.0, vertical="v0")], SESSIONS_SCHEMA),
        funnel=base.funnel,
    )
    assert _metrics(base) == _metrics(grown)


def test_registered_queries_all_have_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert {"alerts_all", "alert_summary", "alert_payload_json", "load_facts"} <= set(QUERIES)
