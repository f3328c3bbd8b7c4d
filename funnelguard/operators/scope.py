"""Active campaigns, scoping of facts, alert modes and thresholds.

The active set is (vertical, campaign) pairs; it is tiny next to the facts
and every check joins its *pre-aggregated* per-campaign metrics to it, so
raw fact rows are never shuffled to attach a vertical. The pair table is
materialised, so the planner knows its size: adaptive execution broadcasts
it when it measures under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and falls back to a shuffled join when it is large.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import effective_threshold, money_sum
from ..functions.materialize import Materializer, run_concurrently
from ..functions.stats import gap_segments
from ..functions.timewin import Clock, in_window, micros
from ..params import Params
from ..schemas import CAMPAIGN_ALERTS, VERTICAL_ALERTS
from ..sources.facts import Facts
from . import rollups


def active_by_spend(facts: Facts, clock: Clock, params: Params) -> DataFrame:
    """O1: (vertical, campaign, name) with positive spend in the last 24 hours."""
    h = facts.hourly
    return (h.where(in_window(h, "timestamp", clock.ago(hours=24), clock.now))
            .groupBy(F.col("vertical").alias("vertical_name"), "campaign_id", "campaign_name")
            .agg(money_sum("spend").alias("recent_spend"))
            .where(F.col("recent_spend") > 0))


def active_by_sessions(facts: Facts, clock: Clock) -> DataFrame:
    """O2: (vertical, campaign) with at least one session in the last 24 hours."""
    s = facts.sessions
    return (s.where(in_window(s, "timestamp", clock.ago(hours=24), clock.now))
            .groupBy(F.col("vertical").alias("vertical_name"), "campaign_id")
            .agg(F.count("session_id").alias("recent_sessions"))
            .where(F.col("recent_sessions") > 0))


def active_campaigns(facts: Facts, clock: Clock, params: Params) -> DataFrame:
    """O3: union of O1 and O2, one row per (vertical, campaign), with a display name."""
    return named_pairs(active_by_spend(facts, clock, params), active_by_sessions(facts, clock))


def named_pairs(by_spend: DataFrame, by_sessions: DataFrame) -> DataFrame:
    """One row per (vertical, campaign) of O1 and O2.

    When one id has several names, the one with the most recent spend wins
    (ties: the smallest name); a NULL or empty name falls back to the id.
    """
    named = F.when(F.col("campaign_name").isNotNull() & (F.col("campaign_name") != ""), F.col("campaign_name"))
    order = F.when(named.isNotNull(), F.struct(-F.col("recent_spend"), F.col("campaign_name")))
    both = by_spend.unionByName(by_sessions, allowMissingColumns=True)
    return (both.groupBy("vertical_name", "campaign_id")
            .agg(F.min_by(named, order).alias("_name"))
            .select("vertical_name", "campaign_id",
                    F.coalesce("_name", "campaign_id").alias("campaign_name")))


#: Inputs of the checks that are made of sessions, and the kind of their tagged rows.
SESSION_INPUTS = {"conversions": rollups.CONVERSION, "sessions": rollups.START, "clickouts": rollups.CLICKOUT}


def conversion_segments(per_second: DataFrame, slice_seconds: int) -> DataFrame:
    """Segments (see ``stats.gap_segments``) of (vertical_name, s, n, last_us), with the last instant of each slice."""
    return gap_segments(per_second, ["vertical_name"], "s", "n", slice_seconds, [F.max("last_us").alias("last_us")])


class Scope:
    """Everything one evaluation reads: facts, clock, parameters, active pairs and rollups.

    The active pairs and each rollup are built at most once per scope and
    materialised (see ``functions.materialize``), so the plans of all
    checks start from the same small tables.
    """

    def __init__(self, facts: Facts, clock: Clock, params: Params, materialize: Materializer,
                 configured: DataFrame | None = None):
        self.facts = facts
        self.clock = clock
        self.params = params
        self.materialize = materialize
        self.configured = configured
        self._cache: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    @classmethod
    def build(cls, facts: Facts, as_of, params: Params | None = None, configured: DataFrame | None = None,
              work_dir: str | None = None) -> "Scope":
        """``configured``: vertical_name of verticals that are checked even without active campaigns."""
        params = params or Params()
        clock = as_of if isinstance(as_of, Clock) else Clock.at(as_of)
        label = clock.now.strftime("%Y%m%dT%H%M%S")
        return cls(facts, clock, params, Materializer(facts.hourly.sparkSession, label, work_dir), configured)

    def close(self) -> None:
        """Delete the intermediate tables; DataFrames of this scope can no longer be read."""
        self.materialize.close()

    def _once(self, name: str, build) -> DataFrame:
        """Build and materialise a shared intermediate once per scope.

        Safe to call from several driver threads: a second caller of the same
        name waits for the first instead of computing it again.
        """
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._cache:
                self._cache[name] = self.materialize(build(), name)
            return self._cache[name]

    def prepare(self, alerts=CAMPAIGN_ALERTS + VERTICAL_ALERTS, threads: int = 4) -> "Scope":
        """Materialise what the given alerts read, running independent writes concurrently.

        Three waves: the active pairs, the fact rollups (independent scans of
        different tables), then the metric tables. Jobs of one
        wave are submitted from ``threads`` driver threads so the scheduler
        overlaps them instead of running many small jobs back to back.
        """
        from . import metrics
        self.active  # noqa: B018
        self._warm(sorted({i for a in alerts for i in metrics.INPUTS[a]}), threads)
        run_concurrently([lambda t=t: self.rows(t, alerts) for t in metrics.tables_of(alerts)], threads, self.materialize.spark)
        return self

    def _warm(self, names, threads: int = 4) -> None:
        """Build the named shared inputs concurrently (no-op for those already built); those of the sessions from one scan."""
        kinds = [SESSION_INPUTS[n] for n in names if n in SESSION_INPUTS]
        others = [n for n in names if n not in SESSION_INPUTS]
        tasks = [lambda: self._tagged(kinds)] if kinds else []
        run_concurrently(tasks + [lambda n=n: getattr(self, n) for n in others], threads, self.materialize.spark)

    def shared(self, name: str, build) -> DataFrame:
        """A check's own intermediate, built and materialised once per scope."""
        return self._once(name, build)

    def _tagged(self, kinds) -> None:
        """Build the session rollups of ``kinds`` that there are none of yet, all of them from one scan of the sessions."""
        with self._guard:
            lock = self._locks.setdefault("tagged", threading.Lock())
        with lock:
            missing = [k for k in dict.fromkeys(kinds) if f"tagged-{k}" not in self._cache]
            if missing:
                tagged = self.materialize(self._session_rollups(missing), "-".join(["sessions", *missing]), by="kind")
                self._cache.update({f"tagged-{k}": tagged for k in missing})

    def _session_rollups(self, kinds) -> DataFrame:
        return rollups.session_rollups(self.scoped, self.clock, kinds)

    def _kind(self, kind: str) -> DataFrame:
        self._tagged([kind])
        return self._cache[f"tagged-{kind}"]

    @property
    def active(self) -> DataFrame:
        """(vertical_name, campaign_id, campaign_name) of active campaigns."""
        return self._once("active", self._active)

    def _active(self) -> DataFrame:
        return active_campaigns(self.facts, self.clock, self.params)

    @property
    def hourly(self) -> DataFrame:
        return self._once("hourly", lambda: rollups.hourly_rollup(self.scoped, self.clock, self.params))

    @property
    def conversions(self) -> DataFrame:
        return rollups.conversions_of(self._kind(rollups.CONVERSION))

    @property
    def sessions(self) -> DataFrame:
        return rollups.sessions_of(self._kind(rollups.START))

    @property
    def clickouts(self) -> DataFrame:
        if self.params.distinct == "bitmaps":
            return self._once("clickout_bitmaps", lambda: rollups.bitmap_clickouts(self.scoped.sessions, self.clock))
        return self._once("clickouts", lambda: rollups.clickouts_of(self._kind(rollups.CLICKOUT), self.clock))

    @property
    def conversion_segments(self) -> DataFrame:
        """(vertical_name, slice, first, last, gaps, last_us): the conversions of four weeks by slices of time."""
        return self._once("conversion_segments", lambda: conversion_segments(
            self._conversion_seconds(), self.params.gap_slice_seconds))

    def _conversion_seconds(self) -> DataFrame:
        return rollups.conversion_seconds(self.facts, self.clock, self.pairs)

    def older_conversions(self, campaigns: DataFrame) -> DataFrame:
        """(campaign_id, last_us): latest conversion before the last 28 days, of the given campaigns."""
        return rollups.older_conversions(self.facts, self.clock, campaigns)

    @property
    def daily_spend(self) -> DataFrame:
        return self._once("daily_spend", lambda: rollups.daily_spend_rollup(self.scoped, self.clock, self.params))

    @property
    def funnel(self) -> DataFrame:
        from .lp_abandonment import LOADER_STEP
        return self._once("funnel", lambda: rollups.funnel_rollup(self.scoped, self.clock, LOADER_STEP))

    def rows(self, table: str, alerts) -> DataFrame:
        """The metric table ``table`` (see ``metrics.TABLES``) with the columns that ``alerts`` need."""
        from . import metrics
        own = tuple(a for a in metrics.TABLES[table] if a in alerts)
        self._warm(sorted({i for a in own for i in metrics.INPUTS[a]}))
        return self._once("-".join((table, *own)), lambda: getattr(metrics, table)(self, own))

    @property
    def scoped(self) -> Facts:
        """The facts of active campaigns: the semi-join is below every rollup's aggregate."""
        ids = self.active.select("campaign_id").distinct()
        return Facts(*(df.join(ids, "campaign_id", "left_semi") for df in self.facts.by_name().values()))

    @property
    def pairs(self) -> DataFrame:
        return self.active.select("vertical_name", "campaign_id")

    @property
    def verticals(self) -> DataFrame:
        """Verticals with active campaigns, and the configured ones: those without data are checked too."""
        active = self.active.select("vertical_name")
        return (active if self.configured is None else active.unionByName(self.configured.select("vertical_name"))).distinct()

    def within(self, lo, hi, col: str = "b") -> Column:
        """Bucket start in [lo, hi) (datetimes; either may be None)."""
        cond = F.col(col).isNotNull()
        if lo is not None:
            cond = cond & (F.col(col) >= F.lit(micros(lo)))
        if hi is not None:
            cond = cond & (F.col(col) < F.lit(micros(hi)))
        return cond

    def per_campaign(self, metrics: DataFrame, with_name: bool = False) -> DataFrame:
        """Attach the vertical (and name) to per-campaign metrics of active campaigns only."""
        side = self.active if with_name else self.pairs
        return side.join(metrics, "campaign_id", "inner")

    def per_vertical(self, per_campaign: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
        """Roll per-campaign partial aggregates up to (vertical, *keys) over active campaigns."""
        return (self.pairs.join(per_campaign, "campaign_id", "inner")
                .groupBy("vertical_name", *keys).agg(*aggs))


def scope_facts(facts: Facts, active: DataFrame) -> Facts:
    """The four fact tables limited to active campaigns, with ``vertical_name`` from the active pairs.

    A campaign active in two verticals has its rows in both. ``active`` is
    small next to the facts and joined as adaptive execution measures it.
    """
    pairs = active.select("vertical_name", "campaign_id")
    return Facts(*(df.join(pairs, "campaign_id") for df in facts.by_name().values()))


def scope_row_counts(scope: Scope) -> DataFrame:
    """O4 reported: rows, and the sum of a measure, of each restricted table per vertical."""
    measures = {"hourly_ad_performance_metrics": "spend", "daily_ad_performance_metrics": "spend",
                "sessions_full_lifecycle": "conversion_payout", "daily_actions_funnel": "users_reached_step"}
    out = None
    for name, df in scope_facts(scope.facts, scope.active).by_name().items():
        part = (df.groupBy("vertical_name")
                .agg(F.count(F.lit(1)).alias("row_count"), money_sum(measures[name]).alias("measure_sum"))
                .select(F.lit(name).alias("table_name"), "vertical_name", "row_count", "measure_sum"))
        out = part if out is None else out.unionByName(part)
    return out


# Mode values produced by alert_modes.
AUTOMATED = "automated"
CONTROLLED = "controlled"
INERT = "inert"  # a mode no check accepts (campaign alerts, observed policy)


def alert_modes(exploded_config: DataFrame, policy: str = "intended") -> DataFrame:
    """The mode and effective threshold of each configured (vertical, alert).

    Campaign alerts: automated -> automated (threshold unused); otherwise a
    base threshold gives a controlled check. Under ``policy='observed'`` that
    controlled mode is inert, as no campaign check accepts the mode the
    dispatcher hands it. Vertical alerts: automated with a base threshold ->
    controlled; automated without one -> automated; not automated -> none.
    Rows without a mode are dropped.
    """
    if policy not in ("intended", "observed"):
        raise ValueError("policy must be 'intended' or 'observed'")
    c = exploded_config
    base_given = F.col("base_threshold").isNotNull()
    auto = F.col("automated")
    campaign = F.col("alert_name").isin(*CAMPAIGN_ALERTS)
    vertical = F.col("alert_name").isin(*VERTICAL_ALERTS)
    campaign_controlled = F.lit(CONTROLLED if policy == "intended" else INERT)
    mode = (F.when(campaign & auto, F.lit(AUTOMATED))
            .when(campaign & base_given, campaign_controlled)
            .when(vertical & auto & base_given, F.lit(CONTROLLED))
            .when(vertical & auto, F.lit(AUTOMATED)))
    automated_mode = mode == F.lit(AUTOMATED)
    return (c.withColumn("level", F.when(campaign, "campaign").when(vertical, "vertical"))
            .withColumn("mode", mode)
            .where(F.col("mode").isNotNull())
            .select("vertical_name", "alert_name", "level", "mode",
                    F.when(automated_mode, F.lit(None).cast("double"))
                    .otherwise(F.col("base_threshold")).alias("base_threshold"),
                    F.when(automated_mode, F.lit(0.0)).otherwise(F.col("percent_increase")).alias("percent_increase"))
            .withColumn("effective_threshold", effective_threshold("base_threshold", "percent_increase")))


def thresholds_for(exploded_config: DataFrame, alert_name: str) -> DataFrame:
    """Configured fixed threshold of one alert per vertical, whatever its mode.

    Returns (vertical_name, base_threshold, effective_threshold) for the
    verticals that give a base threshold.
    """
    return (exploded_config.where((F.col("alert_name") == alert_name) & F.col("base_threshold").isNotNull())
            .select("vertical_name", "base_threshold",
                    effective_threshold("base_threshold", "percent_increase").alias("effective_threshold")))
