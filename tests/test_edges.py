"""Hand-made edge rows: each behaviour of the rules on a few rows."""

from __future__ import annotations

import math
from datetime import timedelta

from factories import AS_OF, config, daily, funnel, hourly, make_facts, session

from funnelguard import Params, evaluate
from funnelguard.operators import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa,
                                   lp_abandonment, performance_decline, volume_drop)
from funnelguard.operators.scope import Scope, alert_modes
from funnelguard.sources.config import config_frame, explode_config

H = timedelta(hours=1)


def _thresholds(spark, value):
    return spark.createDataFrame([("v", value, value)], "vertical_name string, base_threshold double, "
                                                        "effective_threshold double")


def test_spend_without_conversions_gives_null_cpa_unless_zero_filled(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=50.0)])
    row = high_cpa.current(Scope.build(facts, AS_OF)).first()
    assert row.current_6h_cpa is None and row.current_6h_volume is None
    zero = Scope.build(facts, AS_OF, Params(missing="zero"))
    assert high_cpa.current(zero).first().current_6h_cpa == math.inf
    assert not high_cpa.controlled(Scope.build(facts, AS_OF), _thresholds(spark, 5.0)).first().fired
    assert high_cpa.controlled(zero, _thresholds(spark, 5.0)).first().fired


def test_window_edges_in_and_out(spark):
    rows = [session(1, at=AS_OF - 10 * H, conversion=AS_OF - 6 * H),   # exactly as_of - 6h: in
            session(2, at=AS_OF - 10 * H, conversion=AS_OF),           # exactly as_of: out
            session(3, at=AS_OF - 10 * H, conversion=AS_OF - 6 * H - timedelta(microseconds=1))]  # out
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 3 * H, spend=30.0)], session_rows=rows)
    row = high_cpa.current(Scope.build(facts, AS_OF)).first()
    assert row.current_6h_volume == 1 and row.current_6h_cpa == 30.0


def test_clicks_without_clickouts_never_alert(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, clicks=40),
                                           hourly(at=AS_OF - 50 * H, clicks=40)],
                       session_rows=[session(1, at=AS_OF - 50 * H, postback="p1")])
    scope = Scope.build(facts, AS_OF)
    row = fb_to_clickout.rate_24h(scope).first()
    assert row.current_clickouts is None and row.current_fb_to_clickout_rate is None
    assert not fb_to_clickout.controlled(scope, _thresholds(spark, 0.5)).first().fired
    assert fb_to_clickout.automated(scope).first().fired is False


def test_no_conversion_ever_is_infinite_and_fires_controlled(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=5.0)])
    scope = Scope.build(facts, AS_OF)
    row = flow_interruption.controlled(scope, _thresholds(spark, 30.0)).first()
    assert row.minutes_since_conversion == math.inf and row.fired


def _flow_facts(spark, gaps_minutes):
    start = AS_OF.replace(hour=0) - timedelta(days=2)
    t, rows = start, [session(0, at=start - H, conversion=start)]
    for i, g in enumerate(gaps_minutes, 1):
        t = t + timedelta(minutes=g)
        rows.append(session(i, at=t - H, conversion=t))
    return make_facts(spark, hourly_rows=[hourly(at=AS_OF - H, spend=5.0)], session_rows=rows)


def test_flow_needs_five_gaps_and_ignores_long_ones(spark):
    four = flow_interruption.automated(Scope.build(_flow_facts(spark, [10, 10, 10, 10]), AS_OF)).first()
    five = flow_interruption.automated(Scope.build(_flow_facts(spark, [10, 10, 10, 10, 10]), AS_OF)).first()
    assert four.num_gaps == 4 and not four.fired
    assert five.num_gaps == 5 and five.fired and five.dynamic_threshold == 20.0
    kept = flow_interruption.gap_median(Scope.build(_flow_facts(spark, [720, 721]), AS_OF)).first()
    assert kept.num_gaps == 1 and kept.median_gap_minutes == 720.0


def test_zero_spend_today_silences_spend_gated_checks(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=0.0)],
                       daily_rows=[daily(spend=0.0), daily(day=AS_OF.date() - timedelta(days=2), spend=10.0)],
                       session_rows=[session(1, at=AS_OF - 3 * H, conversion=AS_OF - 3 * H, payout=5.0),
                                     session(2, at=AS_OF - 50 * H, conversion=AS_OF - 50 * H, payout=50.0)])
    scope = Scope.build(facts, AS_OF)
    assert not volume_drop.controlled(scope, _thresholds(spark, 100.0)).first().fired
    assert not flow_interruption.controlled(scope, _thresholds(spark, 1.0)).first().fired
    assert not performance_decline.controlled(scope, _thresholds(spark, 100.0)).first().fired
    assert not high_cpa.controlled(scope, _thresholds(spark, -1.0)).first().fired


def test_successes_above_starts_clamp_now_and_exclude_negative_history(spark):
    facts = make_facts(
        spark,
        session_rows=[session(1, at=AS_OF - 2 * H), session(2, at=AS_OF - 3 * 24 * H)],
        funnel_rows=[funnel(users=5), funnel(day=AS_OF.date() - timedelta(days=3), users=9)])
    scope = Scope.build(facts, AS_OF)
    cur = lp_abandonment.abandonment_24h(scope).first()
    assert cur.total_abandoned == 0 and cur.current_rate == 0.0
    prev = lp_abandonment.abandonment_prev_week(scope).first()
    assert prev.last_week_rate < 0
    assert not lp_abandonment.automated(scope).first().fired


def test_name_falls_back_to_id(spark):
    facts = make_facts(spark, hourly_rows=[hourly("c1", name=None), hourly("c2", name=""),
                                           hourly("c3", name="Third")],
                       session_rows=[session(1, campaign="c4")])
    names = {r.campaign_id: r.campaign_name for r in Scope.build(facts, AS_OF).active.collect()}
    assert names == {"c1": "c1", "c2": "c2", "c3": "Third", "c4": "c4"}


def test_config_defaults_and_policies(spark):
    doc = [{"vertical_name": "v", "alerts": {"highCPA": {"globalBaseThreshold": 3.0},
                                            "volumeDrop": {"globalBaseThreshold": 2.0, "automated": True},
                                            "flowInterruption": {"automated": True},
                                            "highLpAbandonment": {"globalBaseThreshold": 0.5}}}]
    exploded = {r.alert_name: r for r in explode_config(config_frame(spark, doc)).collect()}
    assert exploded["highCPA"].percent_increase == 0.0 and exploded["highCPA"].automated is False
    intended = {r.alert_name: r.mode for r in alert_modes(explode_config(config_frame(spark, doc))).collect()}
    observed = {r.alert_name: r.mode
                for r in alert_modes(explode_config(config_frame(spark, doc)), "observed").collect()}
    assert intended == {"highCPA": "controlled", "volumeDrop": "controlled", "flowInterruption": "automated"}
    assert observed == {"highCPA": "inert", "volumeDrop": "controlled", "flowInterruption": "automated"}


def test_percent_raises_threshold_and_evaluate_fires(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=60.0)],
                       session_rows=[session(1, at=AS_OF - 3 * H, conversion=AS_OF - 2 * H)])
    cfg = config(spark, highCPA={"globalBaseThreshold": 50.0, "globalPercent": 10})
    alerts = evaluate(facts, cfg, AS_OF).collect()
    assert len(alerts) == 1
    a = alerts[0]
    assert (a.alert_name, a.campaign_id, a.calculated_value, a.leads) == ("highCPA", "c1", 60.0, 1)
    assert math.isclose(a.benchmark, 55.0) and a.base_threshold == 50.0
    cfg_high = config(spark, highCPA={"globalBaseThreshold": 50.0, "globalPercent": 25})
    assert evaluate(facts, cfg_high, AS_OF).count() == 0
    assert evaluate(facts, config_frame(spark, None), AS_OF).count() == 0


def test_conversion_rate_week_ago_and_today(spark):
    week = AS_OF - timedelta(days=7)
    rows = [session(1, at=AS_OF - 3 * H, postback="a"), session(2, at=AS_OF - 3 * H, postback="b",
                                                              conversion=AS_OF - 2 * H, payout=1.0),
            session(3, at=week - 3 * H, postback="c", conversion=week - 2 * H, payout=1.0)]
    scope = Scope.build(make_facts(spark, session_rows=rows), AS_OF)
    row = clickout_to_conversion.automated(scope).first()
    assert (row.todays_cr, row.last_week_cr) == (0.5, 1.0) and row.fired


def test_no_history_gives_no_learned_cpa_benchmark(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=60.0)],
                       session_rows=[session(1, at=AS_OF - 3 * H, conversion=AS_OF - 2 * H)])
    scope = Scope.build(facts, AS_OF, Params(cpa_history_includes_today=False))
    assert high_cpa.benchmark(scope).count() == 0
    assert high_cpa.automated(scope).count() == 0


def test_configured_vertical_without_active_campaigns_raises_nothing(spark):
    facts = make_facts(spark, hourly_rows=[hourly(at=AS_OF - 2 * H, spend=60.0, vertical="v")],
                       session_rows=[session(1, at=AS_OF - 3 * H, conversion=AS_OF - 2 * H, vertical="v")])
    cfg = config(spark, vertical="other", highCPA={"globalBaseThreshold": 0.0},
                 volumeDrop={"globalBaseThreshold": 100.0, "automated": True},
                 flowInterruption={"globalBaseThreshold": 0.0, "automated": True})
    assert evaluate(facts, cfg, AS_OF).count() == 0
