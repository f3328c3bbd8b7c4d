"""S1 / G1 kept up to date: a store of rollups that a scheduled evaluation reads instead of the facts.

``RollupStore.update`` reads the hours of the fact tables that the store does
not have yet, the open last hour again, and writes their rollups as one load:
sessions in one scan by all their clocks (``rollups.multi_clock``), each
table apart by kind and day, or by date. A row of the ledger, written last
and at once, names the hours and dates that the load covers; only then do
readers see it. Of the loads that cover an hour the newest counts, so that

* an update that fails leaves files that nobody reads, and is run again;
* running an update again, or with ``reopen_hours`` for facts that came late,
  replaces whole hours and never adds rows twice;
* ``compact`` is a load made of stored rows, and ``vacuum`` deletes what no
  reader can reach.

Buckets are ``grid_minutes`` wide, a divisor of the hour: every window of the
checks starts and ends on a bucket if ``as_of`` does, and results equal those
from the facts. There is one writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggs import money_sum
from ..functions.materialize import Materializer, run_concurrently
from ..functions.timewin import Clock, epoch_micros, in_dates, in_window, micros, to_utc_naive, utc_date
from ..operators import rollups
from ..operators.lp_abandonment import LOADER_STEP
from ..operators.scope import Scope, alert_modes, named_pairs
from ..params import Params
from ..sources.config import check_verticals, explode_config
from ..sources.facts import Facts
from .engine import evaluate_scope

SPEND, SESSIONS, DAILY, FUNNEL, BITS, BEFORE = "spend", "sessions", "daily", "funnel", "clickout_bits", "before"
#: The columns that part each table's files (a day is counted since 1970), and the tables by date.
PARTS = {SPEND: ["day"], SESSIONS: ["kind", "day"], BITS: ["day"], DAILY: ["date"], FUNNEL: ["date"]}
BY_DATE = (DAILY, FUNNEL)
HOUR_US = rollups.HOUR_US
LEDGER = ("seq long, load string, lo_hour long, hi_hour long, lo_date date, hi_date date, start_us long, until_us long, grid_us long, "
          "distinct string, schemas string, parts array<string>")


@dataclass(frozen=True)
class Load:
    """A row of the ledger: hours [lo_hour, hi_hour) since 1970 and dates lo_date..hi_date, as known at ``until_us``."""
    seq: int
    load: str
    lo_hour: int
    hi_hour: int
    lo_date: date
    hi_date: date
    start_us: int
    until_us: int
    grid_us: int
    distinct: str
    schemas: str
    parts: list[str]


def _in_runs(value: Column, numbers: list[int]) -> Column:
    """``value`` among ascending numbers, by their runs without a gap."""
    out, first = F.lit(False), None
    for k, n in enumerate(numbers):
        first = n if first is None else first
        if k + 1 == len(numbers) or numbers[k + 1] != n + 1:
            out, first = out | value.between(first, n), None
    return out


def _instant(us: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=us)


class RollupStore:
    """Rollups below ``path``, which driver and executors share; see the module's text.

    ``distinct`` is how click-out sessions are kept: ``rows`` (campaign, session and bucket; any id type) or
    ``bitmaps`` (integer ids that are dense within a campaign), whose days merge without a shuffle of sessions.
    """

    def __init__(self, spark: SparkSession, path: str, grid_minutes: int = 60, distinct: str = "rows"):
        if grid_minutes < 1 or 60 % grid_minutes:
            raise ValueError("grid_minutes divides 60")
        if distinct not in ("rows", "bitmaps"):
            raise ValueError("distinct must be 'rows' or 'bitmaps'")
        self.spark, self.path, self.grid_us, self.distinct = spark, path.rstrip("/"), grid_minutes * 60_000_000, distinct

    # --- ledger ---

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def loads(self) -> list[Load]:
        """The ledger in order: a row for each update, compacted or vacuumed away over time."""
        p, fs = self._fs(f"{self.path}/ledger")
        if not fs.exists(p):
            return []
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/load=*").orderBy("seq").collect()  # metadata: a row for each load
        return [Load(**{**r.asDict(), "parts": list(r.parts)}) for r in rows]

    def _commit(self, load: Load) -> None:
        # one file, seen whole or not at all; a name of its own, so that nothing is replaced
        self.spark.createDataFrame([tuple(vars(load).values())], LEDGER).coalesce(1).write.parquet(f"{self.path}/ledger/load={load.load}")

    def until(self) -> datetime | None:
        """The instant up to which facts are rolled up."""
        loads = self.loads()
        return _instant(max(x.until_us for x in loads)) if loads else None

    # --- writing ---

    def _check_grid(self, instant: datetime) -> int:
        us = micros(instant)
        if us % self.grid_us:
            raise ValueError(f"{instant} does not lie on the store's grid of {self.grid_us // 60_000_000} minutes")
        return us

    def _check_kept(self, loads: list[Load]) -> None:
        for x in loads[:1]:
            if (x.grid_us, x.distinct) != (self.grid_us, self.distinct):
                raise ValueError(f"the store was begun with grid_minutes={x.grid_us // 60_000_000}, distinct={x.distinct!r}")

    def update(self, facts: Facts, until: datetime | str, start: datetime | str | None = None, reopen_hours: int = 0) -> Load | None:
        """Roll up the facts before ``until`` that the store does not have; None if there are none.

        The first update begins at ``start`` (28 days before ``until``), and notes each campaign's last conversion before
        it. Later ones read from the hour of the last ``until`` on, and ``reopen_hours`` before it; daily tables from
        that hour's date on.
        """
        until_us = self._check_grid(to_utc_naive(until))
        loads = self.loads()
        self._check_kept(loads)
        if loads:
            start_us, done = loads[0].start_us, max(x.until_us for x in loads)
            if until_us <= done and not reopen_hours:
                return None
            until_us = max(until_us, done)
            lo_us = max(start_us, done - done % HOUR_US - reopen_hours * HOUR_US)
        else:
            first = to_utc_naive(start) if start is not None else _instant(until_us) - timedelta(days=rollups.HISTORY_DAYS)
            start_us = lo_us = micros(first) - micros(first) % HOUR_US
        lo, hi = _instant(lo_us), _instant(until_us)
        tables = self._rollups(facts, lo, hi, lo.date(), hi.date())
        if not loads:
            s = facts.sessions
            before = s.where(in_window(s, "conversion_dt", None, lo)).groupBy("campaign_id").agg(
                F.max(epoch_micros(s, "conversion_dt")).alias("last_us"))
            before.write.mode("overwrite").parquet(f"{self.path}/{BEFORE}")
        return self._write(tables, loads, lo_us // HOUR_US, -(-until_us // HOUR_US), lo.date(), hi.date(), start_us, until_us)

    def _bucket(self, df: DataFrame, kind: str, column: str):
        us = epoch_micros(df, column)
        return us - F.pmod(us, F.lit(self.grid_us))

    def _rollups(self, facts: Facts, lo: datetime, hi: datetime, first: date, last: date) -> dict[str, DataFrame]:
        day = F.floor(F.col("b") / F.lit(rollups.DAY_US)).alias("day")
        h, s = facts.hourly, facts.sessions
        spend = (h.where(in_window(h, "timestamp", lo, hi))
                 .groupBy("vertical", "campaign_id", "campaign_name", self._bucket(h, SPEND, "timestamp").alias("b"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks")))
        kinds = [k for k in rollups.CLOCKS if k != rollups.CLICKOUT or self.distinct == "rows"]
        sessions = rollups.multi_clock(s, {k: [(lo, hi)] for k in kinds}, self._bucket)
        found = {SPEND: spend.select("*", day), SESSIONS: sessions.select("*", day)}
        if self.distinct == "bitmaps":
            number = F.col("session_id").cast("long")
            bits = (s.where(in_window(s, "session_dt", lo, hi) & F.col("postback_id").isNotNull())
                    .groupBy("campaign_id", self._bucket(s, BITS, "session_dt").alias("b"), F.bitmap_bucket_number(number).alias("_range"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")))
            found[BITS] = bits.select("*", day)
        d, f = facts.daily, facts.funnel
        found[DAILY] = (d.where(in_dates(d, "date", first, last)).groupBy("campaign_id", utc_date(d, "date").alias("date"))
                        .agg(F.sum("spend").alias("spend")))
        found[FUNNEL] = (f.where((F.col("interaction_type") == LOADER_STEP) & in_dates(f, "date", first, last))
                         .groupBy("campaign_id", "page", utc_date(f, "date").alias("date")).agg(F.sum("users_reached_step").alias("users")))
        return found

    def _write(self, tables: dict[str, DataFrame], loads: list[Load], lo_hour: int, hi_hour: int, lo_date: date, hi_date: date,
               start_us: int, until_us: int) -> Load:
        seq = max((x.seq for x in loads), default=0) + 1
        name = f"{seq:08d}-{uuid.uuid4().hex[:8]}"
        # a file for each part, or several where adaptive execution measures it to be large
        run_concurrently([lambda t=t, df=df: df.hint("rebalance", *PARTS[t]).write.partitionBy(*PARTS[t]).parquet(
            f"{self.path}/{t}/load={name}") for t, df in tables.items()], 4, self.spark)
        parts = []
        for t in tables:
            root, fs = self._fs(f"{self.path}/{t}/load={name}")
            found = fs.globStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}=*" for c in PARTS[t])))
            parts += ["/".join([t, *(p.split("=", 1)[1] for p in str(x.getPath().toString()).split("/")[-len(PARTS[t]):])]) for x in found or []]
        load = Load(seq, name, lo_hour, hi_hour, lo_date, hi_date, start_us, until_us, self.grid_us, self.distinct,
                    json.dumps({t: df.schema.json() for t, df in tables.items()}), sorted(parts))
        self._commit(load)
        return load

    def compact(self, before: datetime | str | None = None) -> Load | None:
        """Write all hours and dates before the day of ``before`` (of the last update) anew as one load, with a file or few for each day."""
        loads = self.loads()
        if not loads:
            return None
        self._check_kept(loads)
        until_us = max(x.until_us for x in loads)
        day = to_utc_naive(before) if before is not None else _instant(until_us).replace(hour=0, minute=0, second=0, microsecond=0)
        day = min(day, _instant(until_us)).replace(hour=0, minute=0, second=0, microsecond=0)
        start = _instant(loads[0].start_us)
        if day <= start:
            return None
        tables = {}
        for t in json.loads(loads[0].schemas):
            tables[t] = self.rows(t, start, day) if t not in BY_DATE else self.dates(t, start.date(), (day - timedelta(days=1)).date())
        lo, hi = micros(start) // HOUR_US, micros(day) // HOUR_US
        return self._write(tables, loads, lo, hi, start.date(), (day - timedelta(days=1)).date(), loads[0].start_us, until_us)

    def vacuum(self) -> list[str]:
        """Delete the loads that cover nothing any more, and files of updates that failed; their names."""
        loads = self.loads()
        newest = self._newest(loads)
        used = {x.load for x in newest.values()}
        gone = []
        for x in loads[:-1]:  # the last one keeps the place of the next
            if x.load not in used:
                p, fs = self._fs(f"{self.path}/ledger/load={x.load}")
                fs.delete(p, True)
                gone.append(x.load)
        named = {x.load for x in loads} - set(gone)
        for t in PARTS:
            root, fs = self._fs(f"{self.path}/{t}")
            for status in (fs.listStatus(root) if fs.exists(root) else []):
                name = str(status.getPath().getName()).removeprefix("load=")
                if name not in named:
                    fs.delete(status.getPath(), True)
                    gone.append(name)
        return sorted(set(gone))

    # --- reading ---

    @staticmethod
    def _newest(loads: list[Load]) -> dict[int | date, Load]:
        """The load that counts for each hour and date."""
        newest: dict[int | date, Load] = {}
        for x in loads:
            newest |= dict.fromkeys(range(x.lo_hour, x.hi_hour), x)
            newest |= {x.lo_date + timedelta(days=k): x for k in range((x.hi_date - x.lo_date).days + 1)}
        return newest

    def _read(self, table: str, wanted: list, kind: str | None) -> DataFrame:
        """The rows of the wanted hours or dates: only the folders that the ledger names for them are opened."""
        loads = self.loads()
        if not loads:
            raise ValueError(f"the store at {self.path} is empty: update it first")
        newest = self._newest(loads)
        missing = [w for w in wanted if w not in newest]
        if missing:
            raise ValueError(f"the store at {self.path} does not have {missing[0]}")
        root = f"{self.path}/{table}"
        have = {x.load: set(x.parts) for x in loads}
        kinds = [] if "kind" not in PARTS[table] else [kind] if kind else list(rollups.CLOCKS)
        paths = []
        for load, part in dict.fromkeys((newest[w].load, w if table in BY_DATE else w // 24) for w in wanted):
            for place in [[k, str(part)] for k in kinds] or [[str(part)]]:
                if "/".join([table, *place]) in have[load]:
                    paths.append("/".join([root, f"load={load}", *(f"{c}={v}" for c, v in zip(PARTS[table], place, strict=True))]))
        own = T.StructType.fromJson(json.loads(json.loads(loads[0].schemas)[table]))
        schema = T.StructType([f for f in own if f.name not in PARTS[table]] + [f for f in own if f.name in PARTS[table]])
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema, T.StructField("load", T.StringType())])).option("basePath", root).parquet(*paths)
        if table not in BY_DATE:
            # of a load whose hours a later one covers in part, the others alone
            for x in loads:
                later = sorted(h for h in range(x.lo_hour, x.hi_hour) if newest[h].seq != x.seq)
                if later and any(newest.get(h) is x for h in wanted):
                    hour = F.floor(F.col("b") / F.lit(HOUR_US))
                    rows = rows.where((F.col("load") != x.load) | ~_in_runs(hour, later))
        return rows.select(*schema.names)

    def rows(self, table: str, lo: datetime, hi: datetime, kind: str | None = None) -> DataFrame:
        """Rows of an hourly table whose bucket starts in [lo, hi)."""
        wanted = list(range(micros(lo) // HOUR_US, -(-micros(hi) // HOUR_US)))
        return self._read(table, wanted, kind).where((F.col("b") >= F.lit(micros(lo))) & (F.col("b") < F.lit(micros(hi))))

    def dates(self, table: str, first: date, last: date) -> DataFrame:
        """Rows of a daily table for ``first``..``last``, both included."""
        return self._read(table, [first + timedelta(days=k) for k in range((last - first).days + 1)], None)

    def before(self) -> DataFrame:
        return self.spark.read.schema("campaign_id string, last_us long").parquet(f"{self.path}/{BEFORE}")

    def scope(self, as_of: datetime | str, params: Params | None = None, configured: DataFrame | None = None,
              work_dir: str | None = None) -> "StoredScope":
        """What the checks read at ``as_of``, from stored rollups; ``as_of`` lies on the grid, at most at the last ``until``."""
        loads = self.loads()
        if not loads:
            raise ValueError(f"the store at {self.path} is empty: update it first")
        self._check_kept(loads)
        clock = Clock.at(as_of)
        now = self._check_grid(clock.now)
        if now > max(x.until_us for x in loads) or micros(clock.ago(days=rollups.HISTORY_DAYS)) < loads[0].start_us:
            raise ValueError(f"the store has facts of {_instant(loads[0].start_us)} to {_instant(max(x.until_us for x in loads))}, "
                             f"not of the 28 days before {clock.now}")
        label = "stored-" + clock.now.strftime("%Y%m%dT%H%M%S")
        return StoredScope(self, clock, params or Params(), Materializer(self.spark, label, work_dir), configured)

    def summary(self) -> DataFrame:
        """(table_name, kind, stored_rows, fact_rows) of all that readers see; daily tables have no fact rows."""
        loads = self.loads()
        start, until = _instant(loads[0].start_us), _instant(max(x.until_us for x in loads))
        n = F.count(F.lit(1)).alias("stored_rows")
        facts = F.sum("n").cast("long").alias("fact_rows")
        out = self.rows(SPEND, start, until).agg(n, facts).select(F.lit(SPEND).alias("table_name"), F.lit(None).cast("string").alias("kind"), "stored_rows", "fact_rows")
        out = out.unionByName(self.rows(SESSIONS, start, until).groupBy("kind").agg(n, facts).select(F.lit(SESSIONS).alias("table_name"), "kind", "stored_rows", "fact_rows"))
        for t in BY_DATE:
            out = out.unionByName(self.dates(t, start.date(), until.date()).agg(n).select(
                F.lit(t).alias("table_name"), F.lit(None).cast("string").alias("kind"), "stored_rows", F.lit(None).cast("long").alias("fact_rows")))
        return out


class StoredScope(Scope):
    """A scope whose rollups come from a store: no fact table is read."""

    def __init__(self, store: RollupStore, clock: Clock, params: Params, materialize: Materializer, configured: DataFrame | None = None):
        super().__init__(None, clock, params, materialize, configured)
        self.store = store

    @property
    def scoped(self):
        raise ValueError("a stored scope has no facts")

    def _own(self, df: DataFrame) -> DataFrame:
        return df.join(self.active.select("campaign_id").distinct(), "campaign_id", "left_semi")

    def _within_ranges(self, table: str, ranges, kind: str | None = None) -> DataFrame:
        parts = [self.store.rows(table, lo, hi, kind) for lo, hi in ranges]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _active(self) -> DataFrame:
        day = [(self.clock.ago(hours=24), self.clock.now)]
        by_spend = (self._within_ranges(SPEND, day).groupBy(F.col("vertical").alias("vertical_name"), "campaign_id", "campaign_name")
                    .agg(money_sum("spend").alias("recent_spend")).where("recent_spend > 0"))
        by_sessions = (self._within_ranges(SESSIONS, day, rollups.SEEN).groupBy(F.col("vertical").alias("vertical_name"), "campaign_id")
                       .agg(F.sum("n_sid").alias("recent_sessions")).where("recent_sessions > 0"))
        return named_pairs(by_spend, by_sessions)

    @property
    def hourly(self) -> DataFrame:
        return self._once("hourly", lambda: self._own(self._within_ranges(SPEND, rollups.recent_and_weekday(self.clock)))
                          .groupBy("campaign_id", "b").agg(F.sum("n").alias("n"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks")))

    def _session_rollups(self, kinds) -> DataFrame:
        windows, out = rollups.session_windows(self.clock), None
        for kind in kinds:
            rows = self._own(self._within_ranges(SESSIONS, windows[kind], kind)).drop("day")
            part = rollups.distinct_in_windows(rows, self.clock) if kind == rollups.CLICKOUT else rows
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    @property
    def clickouts(self) -> DataFrame:
        if self.store.distinct == "rows":
            return super().clickouts

        def build() -> DataFrame:
            recent = (F.col("b") >= F.lit(micros(self.clock.ago(days=1)))).alias("recent")
            rows = self._within_ranges(BITS, [(self.clock.ago(days=rollups.RECENT_DAYS), self.clock.now)])
            return rollups.bitmap_counts(self._own(rows).select("campaign_id", recent, "_range", "_bits"))
        return self._once("clickout_bitmaps", build)

    def _warm(self, names, threads: int = 4) -> None:
        if self.store.distinct == "bitmaps" and "clickouts" in names:
            self.clickouts  # noqa: B018
            names = [n for n in names if n != "clickouts"]
        super()._warm(names, threads)

    def _conversion_seconds(self) -> DataFrame:
        rows = self.store.rows(SESSIONS, self.clock.ago(days=rollups.HISTORY_DAYS), self.clock.today, rollups.SECOND)
        return (rows.select("campaign_id", F.col("second").alias("s"), "n", "last_us").join(self.pairs, "campaign_id")
                .groupBy("vertical_name", "s").agg(F.sum("n").alias("n"), F.max("last_us").alias("last_us")))

    def older_conversions(self, campaigns: DataFrame) -> DataFrame:
        old = self.store.before()
        start, stop = _instant(self.store.loads()[0].start_us), self.clock.ago(days=rollups.HISTORY_DAYS)
        if start < stop:
            old = old.unionByName(self.store.rows(SESSIONS, start, stop, rollups.CONVERSION).select("campaign_id", "last_us"))
        return old.join(campaigns, "campaign_id", "left_semi").groupBy("campaign_id").agg(F.max("last_us").alias("last_us"))

    @property
    def daily_spend(self) -> DataFrame:
        return self._once("daily_spend", lambda: self._own(self.store.dates(
            DAILY, self.clock.days_before_today(7).date(), self.clock.today_date)).select("campaign_id", "date", "spend"))

    @property
    def funnel(self) -> DataFrame:
        return self._once("funnel", lambda: self._own(self.store.dates(
            FUNNEL, self.clock.ago(days=rollups.RECENT_DAYS).date(), self.clock.today_date)).select("campaign_id", "page", "date", "users"))


@contextmanager
def stored_evaluation(store: RollupStore, config: DataFrame, as_of: datetime | str, params: Params | None = None, policy: str = "intended",
                      alerts: tuple[str, ...] | None = None, work_dir: str | None = None):
    """``engine.evaluation`` from a store: alerts fired at ``as_of``, without a scan of the facts."""
    check_verticals(config)
    scope = store.scope(as_of, params, config.select("vertical_name"), work_dir)
    try:
        yield evaluate_scope(scope, alert_modes(explode_config(config), policy), alerts)
    finally:
        scope.close()


def backfill(store: RollupStore, config: DataFrame, instants, params: Params | None = None, policy: str = "intended",
             work_dir: str | None = None) -> DataFrame:
    """Alerts at each of the instants, with ``as_of``: the facts are not read, only the store.

    Each instant adds a plan over rollups of its own 36 days at most; the daily tables have the values of the last update,
    also for earlier instants of a day.
    """
    check_verticals(config)
    modes, out = alert_modes(explode_config(config), policy), None
    for instant in instants:
        scope = store.scope(instant, params, config.select("vertical_name"), work_dir)
        part = evaluate_scope(scope, modes).withColumn("as_of", F.lit(scope.clock.now.strftime("%Y-%m-%d %H:%M:%S")))
        out = part if out is None else out.unionByName(part)
    return out
