"""The registered queries: one per operator of the inventory, over the fixture views.

Each query takes (spark, sf_dir), derives the four fact tables from
``<sf_dir>/events.parquet`` and evaluates at the fixture's ``as_of`` with
the fixture config. Output columns carry the same names as the DuckDB
oracle in ``plans.oracle``; instants are rendered as text so both engines
print them identically.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timewin import format_ts
from ..operators import (clickout_to_conversion, fb_to_clickout, flow_interruption, high_cpa,
                         lp_abandonment, performance_decline, volume_drop)
from ..operators.scope import (Scope, active_by_sessions, active_by_spend, alert_modes, scope_row_counts,
                               thresholds_for)
from ..params import Params
from ..schemas import (CLICKOUT_TO_CONVERSION, FB_TO_CLICKOUT, FLOW_INTERRUPTION, HIGH_CPA,
                       HIGH_LP_ABANDONMENT, PERFORMANCE_DECLINE, VOLUME_DROP)
from ..sources import fixture
from ..sources.config import explode_config
from ..sources.facts import row_counts
from .engine import evaluate_scope
from .rollup_store import RollupStore, backfill
from .sinks import alert_payloads, alert_summary, payload_fields, publish, published


class Fixture:
    """Scope, config and modes of the fixture run over one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, policy: str = "intended", store_facts: bool = True,
                 params: Params | None = None):
        self.spark = spark
        self.facts = fixture.fixture_facts(spark, sf_dir, store=store_facts)
        self.document = fixture.fixture_config(spark, sf_dir)
        self.scope = Scope.build(self.facts, fixture.AS_OF, params, self.document.select("vertical_name"))
        self.config = explode_config(self.document)
        self.policy = policy

    def variant(self, policy: str = "intended", **params) -> "Fixture":
        """The same facts and configuration under other options."""
        other = copy(self)
        other.policy = policy
        other.scope = Scope.build(self.facts, fixture.AS_OF, Params(**params), self.scope.configured)
        return other

    def thresholds(self, alert_name: str) -> DataFrame:
        return thresholds_for(self.config, alert_name)

    def modes(self) -> DataFrame:
        """Modes of configured alerts."""
        return alert_modes(self.config, self.policy)

    def alerts(self) -> DataFrame:
        return evaluate_scope(self.scope, self.modes())


def _window_text(df: DataFrame) -> DataFrame:
    return df.withColumn("time_window_start", format_ts(F.timestamp_micros("window_start"))).drop("window_start")


def _campaign_history(fn: Callable[[Scope], DataFrame]) -> Callable[[Fixture], DataFrame]:
    def run(fx: Fixture) -> DataFrame:
        return _window_text(fx.scope.per_campaign(fn(fx.scope)))
    return run


def _q_effective_thresholds(fx: Fixture) -> DataFrame:
    return (fx.modes().where(F.col("effective_threshold").isNotNull())
            .select("vertical_name", "alert_name", "base_threshold", "percent_increase", "effective_threshold"))


def _q_cpa_threshold(fx: Fixture) -> DataFrame:
    return fx.scope.per_campaign(high_cpa.benchmark(fx.scope))


def _q_weighted_median(fx: Fixture) -> DataFrame:
    return fx.scope.per_campaign(high_cpa.benchmark(fx.scope).select("campaign_id", "weighted_median_cpa"))


def _q_weighted_mad(fx: Fixture) -> DataFrame:
    return fx.scope.per_campaign(
        high_cpa.benchmark(fx.scope).select("campaign_id", "weighted_median_cpa", "weighted_mad_cpa"))


def _q_cpa_trimmed(fx: Fixture) -> DataFrame:
    return _window_text(fx.scope.per_campaign(
        high_cpa.trimmed(fx.scope).select("campaign_id", "window_start", "cpa", "window_volume")))


def _q_cpa_history(fx: Fixture) -> DataFrame:
    return _window_text(fx.scope.per_campaign(high_cpa.history(fx.scope)))


def _controlled(check, alert: str) -> Callable[[Fixture], DataFrame]:
    def run(fx: Fixture) -> DataFrame:
        return check.controlled(fx.scope, fx.thresholds(alert))
    return run


def _automated(check) -> Callable[[Fixture], DataFrame]:
    def run(fx: Fixture) -> DataFrame:
        return check.automated(fx.scope)
    return run


def _q_published(fx: Fixture) -> DataFrame:
    """What is published after a run that was repeated, in part and whole."""
    path, alerts = f"{fx.scope.materialize.folder}/published", fx.alerts()
    for some in (alerts.where("alert_name = 'highCPA'"), alerts, alerts):
        publish(some, path, fixture.AS_OF)
    return payload_fields(published(fx.spark, path))


def _store(fx: Fixture, updates: tuple[str, ...] = (fixture.AS_OF,), start: str | None = None, **options) -> RollupStore:
    """A rollup store of the fixture's facts, in the run's folder."""
    store = RollupStore(fx.spark, f"{fx.scope.materialize.folder}/store", **options)
    for until in updates:
        store.update(fx.facts, until, start)
    return store


def _q_incremental(fx: Fixture) -> DataFrame:
    """alerts_all from a store that was updated twice, two hours apart."""
    store = _store(fx, ("2024-01-30 13:00:00", fixture.AS_OF), "2024-01-02 00:00:00")
    return evaluate_scope(store.scope(fixture.AS_OF, fx.scope.params, fx.scope.configured), fx.modes())


def _q_stored_bitmaps(fx: Fixture) -> DataFrame:
    store = _store(fx, distinct="bitmaps", grid_minutes=30)
    return evaluate_scope(store.scope(fixture.AS_OF, fx.scope.params, fx.scope.configured), fx.modes())


def _q_backfill(fx: Fixture) -> DataFrame:
    store = _store(fx, start="2023-12-30 00:00:00")
    return backfill(store, fx.document, fixture.BACKFILL)


_QUERIES: dict[str, Callable[[Fixture], DataFrame]] = {
    # sources, configuration, sinks
    "load_facts": lambda fx: row_counts(fx.facts),
    "alert_config": lambda fx: fx.config,
    "alerts_all": lambda fx: fx.alerts(),
    "alert_payload_json": lambda fx: payload_fields(alert_payloads(fx.alerts(), fixture.AS_OF)),
    "alert_summary": lambda fx: alert_summary(fx.alerts()),
    # scoping and dispatch
    "active_campaigns_by_spend": lambda fx: active_by_spend(fx.facts, fx.scope.clock, fx.scope.params),
    "active_campaigns_by_sessions": lambda fx: active_by_sessions(fx.facts, fx.scope.clock),
    "active_campaigns": lambda fx: fx.scope.active,
    "scope_to_active": lambda fx: scope_row_counts(fx.scope),
    "alert_modes": lambda fx: fx.modes(),
    "effective_thresholds": _q_effective_thresholds,
    # volumeDrop
    "conversions_last_hour": lambda fx: volume_drop.conversions_last_hour(fx.scope),
    "spend_today": lambda fx: volume_drop.spend_today(fx.scope),
    "same_hour_7d_avg": lambda fx: volume_drop.same_hour_average(fx.scope),
    "volume_drop_controlled": _controlled(volume_drop, VOLUME_DROP),
    "volume_drop_automated": _automated(volume_drop),
    # flowInterruption
    "last_conversion": lambda fx: flow_interruption.last_conversion_text(fx.scope),
    "minutes_since_conversion": lambda fx: flow_interruption.minutes_since_conversion(fx.scope),
    "conversion_gaps": lambda fx: flow_interruption.conversion_gaps(fx.scope),
    "gap_median": lambda fx: flow_interruption.gap_median(fx.scope),
    "gap_threshold": lambda fx: flow_interruption.gap_threshold(fx.scope),
    "flow_interruption_controlled": _controlled(flow_interruption, FLOW_INTERRUPTION),
    "flow_interruption_automated": _automated(flow_interruption),
    # highCPA
    "cpa_spend_6h": lambda fx: fx.scope.per_campaign(high_cpa.spend_6h(fx.scope)),
    "cpa_volume_6h": lambda fx: fx.scope.per_campaign(high_cpa.volume_6h(fx.scope)),
    "cpa_current": lambda fx: high_cpa.current(fx.scope),
    "cpa_spend_history": _campaign_history(high_cpa.spend_history),
    "cpa_volume_history": _campaign_history(high_cpa.volume_history),
    "cpa_history": _q_cpa_history,
    "cpa_trimmed": _q_cpa_trimmed,
    "weighted_median": _q_weighted_median,
    "weighted_mad": _q_weighted_mad,
    "cpa_threshold": _q_cpa_threshold,
    "high_cpa_controlled": _controlled(high_cpa, HIGH_CPA),
    "high_cpa_automated": _automated(high_cpa),
    # performanceDecline
    "roi_today": lambda fx: performance_decline.roi_today(fx.scope),
    "roi_last_week": lambda fx: performance_decline.roi_last_week(fx.scope),
    "performance_decline_controlled": _controlled(performance_decline, PERFORMANCE_DECLINE),
    "performance_decline_automated": _automated(performance_decline),
    # fbToClickout
    "clickout_rate_24h": lambda fx: fb_to_clickout.rate_24h(fx.scope),
    "clickout_rate_prev_week": lambda fx: fb_to_clickout.rate_prev_week(fx.scope),
    "fb_to_clickout_controlled": _controlled(fb_to_clickout, FB_TO_CLICKOUT),
    "fb_to_clickout_automated": _automated(fb_to_clickout),
    # clickoutToConversion
    "conversion_rate_today": lambda fx: clickout_to_conversion.rate_today(fx.scope),
    "conversion_rate_week_ago": lambda fx: clickout_to_conversion.rate_week_ago(fx.scope),
    "clickout_to_conversion_controlled": _controlled(clickout_to_conversion, CLICKOUT_TO_CONVERSION),
    "clickout_to_conversion_automated": _automated(clickout_to_conversion),
    # highLpAbandonment
    "lp_started_24h": lambda fx: lp_abandonment.started_24h(fx.scope),
    "lp_success_24h": lambda fx: lp_abandonment.success_24h(fx.scope),
    "lp_abandonment_24h": lambda fx: lp_abandonment.abandonment_24h(fx.scope),
    "lp_abandonment_prev_week": lambda fx: lp_abandonment.abandonment_prev_week(fx.scope),
    "lp_abandonment_controlled": _controlled(lp_abandonment, HIGH_LP_ABANDONMENT),
    "lp_abandonment_automated": _automated(lp_abandonment),
    # options
    "alert_modes_observed": lambda fx: fx.variant(policy="observed").modes(),
    "same_hour_7d_avg_zero_fill": lambda fx: volume_drop.same_hour_average(fx.variant(volume_avg_zero_fill=True).scope),
    "cpa_history_without_today": lambda fx: _q_cpa_history(fx.variant(cpa_history_includes_today=False)),
    "roi_today_missing_zero": lambda fx: performance_decline.roi_today(fx.variant(missing="zero").scope),
    "clickout_rate_24h_bitmaps": lambda fx: fb_to_clickout.rate_24h(fx.variant(distinct="bitmaps").scope),
    "clickout_rate_prev_week_bitmaps": lambda fx: fb_to_clickout.rate_prev_week(fx.variant(distinct="bitmaps").scope),
    "alerts_published": _q_published,
    # the rollup store
    "rollup_store_rows": lambda fx: _store(fx).summary(),
    "alerts_all_incremental": _q_incremental,
    "alerts_all_bitmaps": _q_stored_bitmaps,
    "alerts_backfill": _q_backfill,
}


def _rounded(query: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    """``query`` with its DOUBLE columns rounded to 6 decimals: sums of doubles depend on the order of rows in either engine."""
    def run(fx: Fixture) -> DataFrame:
        df = query(fx)
        return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
    return run


QUERIES: dict[str, Callable[[Fixture], DataFrame]] = {name: _rounded(q) for name, q in _QUERIES.items()}


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Fixture(spark, sf_dir))
