"""The rollup store: what it gives equals the facts, whatever the order of updates."""

from __future__ import annotations

import random
import uuid
from collections import Counter
from datetime import datetime, timedelta

import pytest
from factories import AS_OF, config, daily, funnel, hourly, make_facts, session
from pyspark.sql import functions as F

from funnelguard import evaluation
from funnelguard.operators import rollups
from funnelguard.operators.scope import Scope
from funnelguard.params import Params
from funnelguard.plans.rollup_store import RollupStore, backfill, stored_evaluation
from funnelguard.session import ensure_checkpoint_dir

START = AS_OF - timedelta(days=31)


def random_rows(seed=0, n=700):
    """Facts of 5 campaigns in 2 verticals over 40 days, dense in the last two; ids null, negative and repeated."""
    rng = random.Random(seed)

    def at():
        back = rng.random() * (2 if rng.random() < 0.4 else 40) * 86400
        return (AS_OF + timedelta(hours=1) - timedelta(seconds=back)).replace(microsecond=rng.choice([0, 0, 999_999]))

    sessions, spend = [], []
    for i in range(n):
        k, t = rng.randrange(5), at()
        conv = t + timedelta(minutes=rng.randrange(200)) if rng.random() < 0.5 else None
        sessions.append(session(rng.choice([None, -i, i, i // 2, i + 40_000]), f"c{k}", t, f"/p{k % 2}", "p" if rng.random() < 0.6 else None,
                                conv, rng.choice([None, 5.0]) if conv else None, f"v{k % 2}"))
    for i in range(n):
        k = rng.randrange(5)
        spend.append(hourly(f"c{k}", at().replace(minute=0, second=0, microsecond=0), float(rng.randrange(9)), rng.randrange(9),
                            rng.choice([f"Camp {k}", "", None]), f"v{k % 2}"))
    days = [AS_OF.date() - timedelta(days=d) for d in range(35)]
    return (spend, [daily(f"c{k}", d, float(rng.randrange(1, 9))) for k in range(5) for d in days], sessions,
            [funnel(f"c{k}", f"/p{k % 2}", d, rng.choice(["loader", "form"]), rng.randrange(4)) for k in range(5) for d in days])


@pytest.fixture(scope="module")
def cfg(spark):
    every = {a: {"automated": True, "globalBaseThreshold": None} for a in
             ("highCPA", "performanceDecline", "fbToClickout", "clickoutToConversion", "volumeDrop", "flowInterruption", "highLpAbandonment")}
    return config(spark, "v0", **every).unionByName(config(spark, "v1", **{
        a: {"globalBaseThreshold": 0.4 if a == "highLpAbandonment" else 2.0, "automated": a in ("volumeDrop", "flowInterruption", "highLpAbandonment")}
        for a in every}))


@pytest.fixture
def store(spark):
    def make(**options):
        return RollupStore(spark, f"{ensure_checkpoint_dir(spark)}/store-test-{uuid.uuid4().hex}", **options)
    return make


def alerts_of(df):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def from_facts(facts, cfg, as_of, **options):
    with evaluation(facts, cfg, as_of, **options) as alerts:
        return alerts_of(alerts)


def from_store(stored, cfg, as_of, **options):
    with stored_evaluation(stored, cfg, as_of, **options) as alerts:
        return alerts_of(alerts)


@pytest.mark.parametrize("options,as_of", [({"grid_minutes": 15}, AS_OF + timedelta(minutes=45)), ({"distinct": "bitmaps"}, AS_OF)])
def test_updates_in_steps_equal_the_facts(spark, store, cfg, options, as_of):
    facts, stored = make_facts(spark, *random_rows()), store(**options)
    step = timedelta(minutes=15) if options.get("grid_minutes") else timedelta(hours=1)
    for until in (as_of - timedelta(days=2), as_of - 5 * step, as_of - step, as_of):
        stored.update(facts, until, START)
    want = from_facts(facts, cfg, as_of)
    assert want and from_store(stored, cfg, as_of) == want
    # an earlier instant reads nothing later
    assert from_store(stored, cfg, as_of - step) == from_facts(facts, cfg, as_of - step)


def test_backfill_equals_single_runs(spark, store, cfg):
    facts, stored = make_facts(spark, *random_rows(1, 300)), store()
    instants = [AS_OF.replace(hour=0), AS_OF - timedelta(hours=2), AS_OF]
    stored.update(facts, AS_OF, START)
    got = alerts_of(backfill(stored, cfg, instants))
    want = Counter()
    for t in instants:
        want.update({(*k, str(t)): n for k, n in from_facts(facts, cfg, t).items()})
    assert got == want


def test_an_update_reads_only_new_hours_and_an_evaluation_no_facts(spark, store, cfg, monkeypatch, tmp_path):
    facts, stored = make_facts(spark, *random_rows(2, 200)), store()
    for name, df in facts.by_name().items():
        df.write.parquet(f"{tmp_path}/{name}")
    from funnelguard import load_facts

    facts = load_facts(spark, str(tmp_path), fmt="parquet")
    stored.update(facts, AS_OF - timedelta(hours=1))
    plans = {}
    write = RollupStore._write
    monkeypatch.setattr(RollupStore, "_write", lambda self, tables, *a: (
        plans.update({t: df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
                      for t, df in tables.items()}), write(self, tables, *a))[1])
    load = stored.update(facts, AS_OF)
    assert (load.hi_hour - load.lo_hour) == 1
    pushed = [line for line in plans["sessions"].splitlines() if "FileScan" in line]
    assert len(pushed) == 1 and "2024-01-30 14:00:00" in plans["sessions"] and "2024-01-02" not in plans["sessions"]
    assert "2024-01-30 14:00:00" in plans["spend"]
    with stored_evaluation(stored, cfg, AS_OF) as alerts:
        scope_plan = alerts._jdf.queryExecution().optimizedPlan().toString()
        assert str(tmp_path) not in scope_plan
        alerts.collect()
    with pytest.raises(ValueError, match="no facts"):
        stored.scope(AS_OF).scoped  # noqa: B018


def test_repeated_failed_and_late_updates(spark, store, cfg, monkeypatch):
    spend, days, sessions, pages = random_rows(3, 250)
    late = [session(10_000 + i, "c1", AS_OF - timedelta(hours=2, minutes=i), "/p1", "p", AS_OF - timedelta(hours=2), 3.0, "v1") for i in range(9)]
    facts, more = make_facts(spark, spend, days, sessions, pages), make_facts(spark, spend, days, sessions + late, pages)
    stored = store()
    stored.update(facts, AS_OF - timedelta(hours=3), START)
    commit = RollupStore._commit

    def fail(self, load):
        raise OSError("no ledger")

    monkeypatch.setattr(RollupStore, "_commit", fail)
    with pytest.raises(OSError):
        stored.update(facts, AS_OF)
    assert stored.until() == AS_OF - timedelta(hours=3)
    monkeypatch.setattr(RollupStore, "_commit", commit)
    stored.update(facts, AS_OF)
    assert stored.update(facts, AS_OF) is None and stored.update(facts, AS_OF - timedelta(hours=5)) is None
    want = from_facts(facts, cfg, AS_OF)
    assert from_store(stored, cfg, AS_OF) == want
    rows = {tuple(r) for r in stored.summary().collect()}
    stored.update(facts, AS_OF, reopen_hours=30)
    assert {tuple(r) for r in stored.summary().collect()} == rows
    stored.update(more, AS_OF, reopen_hours=4)
    assert from_store(stored, cfg, AS_OF) == from_facts(more, cfg, AS_OF)
    rows = {tuple(r) for r in stored.summary().collect()}
    stored.compact()
    gone = stored.vacuum()
    assert gone and {tuple(r) for r in stored.summary().collect()} == rows and stored.vacuum() == []
    assert from_store(stored, cfg, AS_OF) == from_facts(more, cfg, AS_OF)


def test_what_a_store_refuses(spark, store, cfg):
    facts, stored = make_facts(spark, [hourly()], [daily()], [session()], [funnel()]), store()
    with pytest.raises(ValueError, match="empty"):
        stored.scope(AS_OF)
    with pytest.raises(ValueError, match="grid"):
        stored.update(facts, AS_OF + timedelta(minutes=5))
    stored.update(facts, AS_OF)
    with pytest.raises(ValueError, match="28 days"):
        stored.scope(AS_OF + timedelta(hours=1))
    with pytest.raises(ValueError, match="28 days"):
        stored.scope(AS_OF - timedelta(days=1))
    with pytest.raises(ValueError, match="grid_minutes"):
        RollupStore(spark, stored.path, grid_minutes=7)
    with pytest.raises(ValueError, match="begun with"):
        RollupStore(spark, stored.path, distinct="bitmaps").scope(AS_OF)
    assert from_store(stored, cfg, AS_OF) == from_facts(facts, cfg, AS_OF)


def test_bitmaps_count_what_rows_count(spark):
    facts = make_facts(spark, *random_rows(4))
    rows = {}
    for distinct in ("rows", "bitmaps"):
        scope = Scope.build(facts, AS_OF, Params(distinct=distinct))
        rows[distinct] = {tuple(r) for r in scope.clickouts.collect()}
    assert rows["rows"] == rows["bitmaps"] and len(rows["rows"]) == 5
    text = facts.sessions.withColumn("session_id", F.col("session_id").cast("string"))
    with pytest.raises(ValueError, match="integer"):
        rollups.bitmap_clickouts(text, Scope.build(facts, AS_OF).clock)
    counted = rollups.bitmap_clickouts(facts.sessions, Scope.build(facts, AS_OF).clock)
    assert counted.where("current_clickouts < 0").count() == 0


def test_one_scan_for_all_clocks(spark):
    facts = make_facts(spark, *random_rows(5, 50))
    clock = Scope.build(facts, AS_OF).clock
    plan = rollups.session_rollups(facts, clock, list(rollups.session_windows(clock)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation [") == 1


def test_silent_vertical_finds_its_last_conversion_before_the_store(spark, store):
    old = datetime(2023, 11, 2, 8, 0)
    facts = make_facts(spark, [hourly("c1", vertical="v")], [daily()], [session(1, "c1", old, "/p", "p", old, 1.0)], [])
    cfg = config(spark, "v", flowInterruption={"globalBaseThreshold": 30.0, "automated": True})
    stored = store()
    stored.update(facts, AS_OF)
    want = from_facts(facts, cfg, AS_OF)
    assert len(want) == 1 and from_store(stored, cfg, AS_OF) == want
