"""Plan shape: pushdown, pruning, no Python UDFs, no single-partition windows, constant actions."""

from __future__ import annotations

from funnelguard.operators import high_cpa, rollups
from funnelguard.plans.catalog import Fixture

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_scan_pushes_time_range_and_prunes_columns(spark):
    fx = Fixture(spark, SF)
    plan = _plan(rollups.session_rollups(fx.facts, fx.scope.clock, [rollups.CONVERSION]))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "conversion_dt" in scan.split("PushedFilters:")[1]
    read_schema = scan.split("ReadSchema:")[1]
    assert "page" not in read_schema and "postback_id" not in read_schema


def test_no_python_udf_and_no_unpartitioned_window(spark):
    fx = Fixture(spark, SF)
    for df in (fx.alerts(), high_cpa.benchmark(fx.scope), fx.scope.rows("vertical_metrics", ("volumeDrop", "flowInterruption"))):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "SinglePartition" not in plan


def test_action_count_does_not_grow_with_campaigns(spark):
    """Evaluating four times as many campaigns runs (about) the same number of Spark jobs."""
    from datetime import timedelta

    from factories import AS_OF, config, hourly, make_facts, session

    from funnelguard import evaluate

    tracker = spark.sparkContext.statusTracker()
    cfg = config(spark, highCPA={"automated": True}, volumeDrop={"automated": True},
                 fbToClickout={"globalBaseThreshold": 0.5})

    def jobs_for(n_campaigns):
        hours = [timedelta(hours=h) for h in (1, 2, 30, 170)]
        facts = make_facts(
            spark,
            hourly_rows=[hourly(f"c{i}", at=AS_OF - h, spend=10.0 + i) for i in range(n_campaigns) for h in hours],
            session_rows=[session(i * 10 + k, f"c{i}", at=AS_OF - h, postback="p", conversion=AS_OF - h)
                          for i in range(n_campaigns) for k, h in enumerate(hours)])
        group = f"jobs-{n_campaigns}"
        spark.sparkContext.setJobGroup(group, group)
        evaluate(facts, cfg, AS_OF).write.format("noop").mode("overwrite").save()
        return len(tracker.getJobIdsForGroup(group))

    # adaptive execution turns stages into jobs depending on data sizes; without it the
    # job count is a function of the plan shape only, which must not depend on campaigns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few, many = jobs_for(3), jobs_for(12)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert few == many, (few, many)


def test_a_full_run_reads_the_sessions_three_times(spark, monkeypatch):
    """Once for the active set, once for all session clocks, once for the gaps; no conversion is shuffled by campaign and second."""
    from funnelguard.functions.materialize import Materializer

    plans = []
    write = Materializer.__call__
    monkeypatch.setattr(Materializer, "__call__", lambda self, df, name, by=None: (
        plans.append((name, _plan(df))), write(self, df, name, by))[1])
    fx = Fixture(spark, SF)
    plans.clear()
    fx.alerts().collect()
    reads = {name: sum("FileScan parquet" in line and "session_dt" in line + line.split("ReadSchema:")[1] or
                       "FileScan parquet" in line and "conversion_dt" in line for line in plan.splitlines()) for name, plan in plans}
    reads = {name: n for name, n in reads.items() if n}
    # the older sessions are read only if a vertical has no conversion in four weeks
    silent = {name for name in reads if name.startswith("vertical_metrics") or name == "silent_campaigns"}
    assert sum(n for name, n in reads.items() if name not in silent) <= 2, reads
    active = dict(plans)["active"]
    assert sum("FileScan parquet" in line and "session_id" in line for line in active.splitlines()) == 1
    exchanges = [line for _, plan in plans for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("campaign_id" in line and ("s#" in line or "second#" in line) and "kind#" not in line for line in exchanges)


def test_conversions_are_read_for_a_week_and_one_weekday(spark):
    fx = Fixture(spark, SF)
    ranges = rollups.recent_and_weekday(fx.scope.clock)
    assert len(ranges) == 4 and sum((hi - lo).total_seconds() for lo, hi in ranges) < 11 * 86400
    plan = _plan(rollups.hourly_rollup(fx.facts, fx.scope.clock, fx.scope.params))
    pushed = next(line for line in plan.splitlines() if "FileScan parquet" in line).split("PushedFilters:")[1]
    assert "Or(Or(Or(And(GreaterThanOrEqual(timestamp," in pushed
