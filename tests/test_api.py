"""Public entry points and the behaviour options of Params."""

from __future__ import annotations

import json
import uuid
from datetime import timedelta

import pytest
from factories import AS_OF, config, daily, hourly, make_facts, session

from funnelguard import Params, Scope, config_frame, evaluate, evaluation, load_facts, scope_facts
from funnelguard.operators import high_cpa, volume_drop
from funnelguard.operators.scope import active_by_spend
from funnelguard.session import ensure_checkpoint_dir
from funnelguard.sources import fixture
from funnelguard.sources.facts import FACT_TABLES

H = timedelta(hours=1)


def test_load_facts_from_a_parquet_directory(spark):
    root = f"{ensure_checkpoint_dir(spark)}/api-facts-{uuid.uuid4().hex}"
    for name, df in fixture.fixture_facts(spark, "/root/testdata/sf0.001").by_name().items():
        df.write.parquet(f"{root}/{name}")
    facts = load_facts(spark, root, fmt="parquet")
    assert set(facts.by_name()) == set(FACT_TABLES)
    cfg = fixture.fixture_config(spark, "/root/testdata/sf0.001")
    assert evaluate(facts, cfg, fixture.AS_OF).count() == \
        evaluate(fixture.fixture_facts(spark, "/root/testdata/sf0.001"), cfg, fixture.AS_OF).count()


def test_config_from_a_json_document(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps([{"vertical_name": "v", "alerts": {"highCPA": {"globalBaseThreshold": 50}}}]))
    rows = config_frame(spark, str(path)).collect()
    assert rows[0].vertical_name == "v" and rows[0].alerts["highCPA"].globalBaseThreshold == 50.0


def _cpa_facts(spark):
    return make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=60.0)],
                      session_rows=[session(1, at=AS_OF - 3 * H, conversion=AS_OF - 2 * H)])


def test_observed_policy_never_fires_fixed_campaign_thresholds(spark):
    cfg = config(spark, highCPA={"globalBaseThreshold": 50.0})
    facts = _cpa_facts(spark)
    assert evaluate(facts, cfg, AS_OF).count() == 1
    assert evaluate(facts, cfg, AS_OF, policy="observed").count() == 0


def test_history_without_today_drops_todays_buckets(spark):
    rows = [hourly(at=AS_OF - 2 * H, spend=60.0), hourly(at=AS_OF - 7 * 24 * H, spend=20.0)]
    convs = [session(1, at=AS_OF - 3 * H, conversion=AS_OF - 2 * H),
             session(2, at=AS_OF - 7 * 24 * H, conversion=AS_OF - 7 * 24 * H)]
    facts = make_facts(spark, hourly_rows=rows, session_rows=convs)
    with_today = high_cpa.history(Scope.build(facts, AS_OF)).count()
    without = high_cpa.history(Scope.build(facts, AS_OF, Params(cpa_history_includes_today=False))).count()
    assert (with_today, without) == (2, 1)


def test_same_hour_average_zero_fill(spark):
    day = timedelta(days=1)
    convs = [session(1, at=AS_OF - day - H, conversion=AS_OF - day + timedelta(minutes=10)),
             session(2, at=AS_OF - 2 * day - H, conversion=AS_OF - 2 * day + timedelta(minutes=10)),
             session(3, at=AS_OF - 2 * day - H, conversion=AS_OF - 2 * day + timedelta(minutes=20))]
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - H)], session_rows=convs)
    plain = volume_drop.same_hour_average(Scope.build(facts, AS_OF)).first()
    filled = volume_drop.same_hour_average(Scope.build(facts, AS_OF, Params(volume_avg_zero_fill=True))).first()
    assert (plain.same_hour_avg, plain.days_with_conversions) == (1.5, 2)
    assert filled.same_hour_avg == 3 / 7


def test_money_keeps_small_large_and_decimal_values(spark):
    facts = make_facts(spark, hourly_rows=[hourly("tiny", spend=4e-7), hourly("huge", spend=1e12), hourly("huge", spend=5.0)])
    found = {r.campaign_id: r.recent_spend for r in active_by_spend(facts, Scope.build(facts, AS_OF).clock, Params()).collect()}
    assert found == {"tiny": 4e-7, "huge": 1e12 + 5}
    exact = facts.hourly.withColumn("spend", facts.hourly.spend.cast("decimal(38,10)"))
    clock = Scope.build(facts, AS_OF).clock
    again = active_by_spend(type(facts)(exact, facts.daily, facts.sessions, facts.funnel), clock, Params()).collect()
    assert {r.campaign_id: r.recent_spend for r in again} == found


def test_a_configured_vertical_without_campaigns_is_checked(spark):
    facts = make_facts(spark, hourly_rows=[hourly()])
    cfg = config(spark, "dead", volumeDrop={"globalBaseThreshold": 5, "automated": True},
                 flowInterruption={"globalBaseThreshold": 30, "automated": True})
    assert evaluate(facts, cfg, AS_OF).count() == 0  # it spends nothing
    fired = {r.alert_name for r in evaluate(facts, cfg, AS_OF, Params(min_spend_for_cpa_alert=-1)).collect()}
    assert fired == {"volumeDrop", "flowInterruption"}


def test_only_what_the_wanted_alerts_read_is_built(spark):
    import os

    facts = _cpa_facts(spark)
    cfg = config(spark, highCPA={"globalBaseThreshold": 50.0}, volumeDrop={"automated": True})
    root = f"{ensure_checkpoint_dir(spark)}/wanted-{uuid.uuid4().hex}"
    with evaluation(facts, cfg, AS_OF, alerts=("highCPA",), work_dir=root) as alerts:
        assert alerts.count() == 1
        run, = os.listdir(f"{root}/funnelguard")
        assert sorted(os.listdir(f"{root}/funnelguard/{run}")) == [
            "active", "campaign_metrics-highCPA", "cpa_trimmed", "hourly", "sessions-conversion"]
    assert os.listdir(f"{root}/funnelguard") == []  # the folder goes with the block
    with pytest.raises(ZeroDivisionError), evaluation(facts, cfg, AS_OF, work_dir=root):
        1 / 0  # noqa: B018
    assert os.listdir(f"{root}/funnelguard") == []
    with pytest.raises(ValueError, match="nonsense"):
        evaluate(facts, cfg, AS_OF, alerts=("nonsense",))


def test_a_shared_folder_must_be_named(spark, monkeypatch):
    monkeypatch.setattr("funnelguard.functions.materialize.checkpoint_root", lambda _: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        evaluate(_cpa_facts(spark), config(spark, highCPA={"automated": True}), AS_OF)


def test_config_errors_are_errors(spark, tmp_path):
    path = tmp_path / "config.json"
    for text in ('[{"vertical_name": "v", "alerts": {"highCPA": ', '[{"vertical_name": "v", "alerts": {"highCPA": {"globalBaseThreshold": "40"}}}]'):
        path.write_text(text)
        with pytest.raises(Exception, match="(?i)malformed"):
            config_frame(spark, str(path)).collect()
    with pytest.raises(ValueError, match="several"):
        evaluate(_cpa_facts(spark), config_frame(spark, [{"vertical_name": "v", "alerts": {}}] * 2), AS_OF)
    with pytest.raises(ValueError, match="number"):
        config(spark, highCPA={"globalBaseThreshold": "40"})


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_alerts_do_not_depend_on_the_time_zone_of_the_session(spark, kind):
    def alerts(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)
        sf = "/root/testdata/sf0.001"
        facts = load_facts(spark, root, fmt="parquet")
        rows = evaluate(facts, fixture.fixture_config(spark, sf), fixture.AS_OF).collect()
        return sorted(tuple(str(v) for v in r) for r in rows)

    root = f"{ensure_checkpoint_dir(spark)}/zone-{uuid.uuid4().hex}"
    stamps = {"timestamp", "session_dt", "conversion_dt"}
    for name, df in fixture.fixture_facts(spark, "/root/testdata/sf0.001").by_name().items():
        df.select(*[df[c].cast(kind) if c in stamps else df[c] for c in df.columns]).write.parquet(f"{root}/{name}")
    try:
        utc = alerts("UTC")
        assert utc and alerts("America/New_York") == utc and alerts("Asia/Kolkata") == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_older_conversions_are_found_and_string_dates_read(spark):
    from funnelguard.operators import flow_interruption

    old = AS_OF - timedelta(days=40)
    facts = make_facts(spark, hourly_rows=[hourly("c1"), hourly("c2", vertical="w")], daily_rows=[daily("c1")],
                       session_rows=[session(1, "c1", at=old, conversion=old),
                                     session(2, "c2", at=AS_OF - H, conversion=AS_OF - H, vertical="w")])
    text = facts.daily.withColumn("date", facts.daily.date.cast("string"))
    from funnelguard.sources.facts import facts_from_frames
    facts = facts_from_frames(facts.by_name() | {"daily_ad_performance_metrics": text})
    assert dict(facts.daily.dtypes)["date"] == "date"
    got = {r.vertical_name: r.minutes_since_conversion for r in
           flow_interruption.minutes_since_conversion(Scope.build(facts, AS_OF)).collect()}
    assert got == {"v": 40 * 24 * 60.0, "w": 60.0}


def test_restricted_facts_carry_the_active_vertical(spark):
    facts = make_facts(spark, hourly_rows=[hourly("c1"), hourly("c1", vertical="w"), hourly("gone", at=AS_OF - 100 * H)])
    rows = scope_facts(facts, Scope.build(facts, AS_OF).active).hourly.collect()
    assert sorted((r.campaign_id, r.vertical_name) for r in rows) == [("c1", "v")] * 2 + [("c1", "w")] * 2
