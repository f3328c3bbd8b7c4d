"""Test-fixture views: the four fact tables derived from the shared ``events`` table.

The SQL text below runs unchanged in Spark and in DuckDB, so a query over
these views has an independent oracle. Six campaigns, two verticals, four
landing pages; from 2024-01-29 on page ``/lp/0`` loses its loader events.

A second part of each view has 40 campaigns ``d0`` to ``d39`` in two further
verticals. ``d0`` has a third of the rows and stands in both; some have no
sessions, some no spend, one no name and one an empty name; on the day of
``as_of`` conversions stop at 03:00, so that both verticals are silent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import Materializer, run_concurrently
from .facts import DAILY, FUNNEL, HOURLY, SESSIONS, Facts, facts_from_frames

AS_OF = "2024-01-30 15:00:00"
#: Instants of the backfill query: over midnight, at which days and weekdays change.
BACKFILL = ("2024-01-29 22:00:00", "2024-01-30 00:00:00", "2024-01-30 15:00:00")

# --- Fixed values: fixture view definitions (shared with the DuckDB oracle) ---
VIEW_SQL: dict[str, str] = {
    SESSIONS: """
select cast(floor(event_id / 2) as bigint) as session_id,
       concat('c', cast(user_id % 6 as string)) as campaign_id,
       concat('v', cast(user_id % 2 as string)) as vertical,
       concat('/lp/', cast(user_id % 4 as string)) as page,
       ts as timestamp, ts as session_dt,
       case when event_type in ('signup','purchase') then cast(event_id as string) end as postback_id,
       case when event_type = 'purchase' then ts + interval 20 minutes end as conversion_dt,
       case when event_type = 'purchase' then value end as conversion_payout
from events where event_type in ('view','signup','purchase')
union all
select cast(1000000000 + event_id as bigint), concat('d', cast(case when user_id % 3 = 0 then 0 else user_id % 40 end as string)), concat('w', cast(user_id % 2 as string)),
       concat('/lw/', cast(user_id % 4 as string)), ts, ts,
       case when event_type in ('signup','purchase') then cast(event_id as string) end,
       case when event_type = 'purchase' and ts < timestamp '2024-01-30 03:00:00' then ts + interval 20 minutes end,
       case when event_type = 'purchase' and ts < timestamp '2024-01-30 03:00:00'
            then case when ts >= timestamp '2024-01-30 00:00:00' then value * 1000 else value end end
from events where event_type in ('view','signup','purchase') and (user_id % 3 = 0 or user_id % 40 not in (32, 33, 34, 35))
""",
    HOURLY: """
select concat('c', cast(user_id % 6 as string)) as campaign_id,
       concat('Campaign ', cast(user_id % 6 as string)) as campaign_name,
       concat('v', cast(user_id % 2 as string)) as vertical,
       date_trunc('hour', ts) as timestamp,
       cast(sum(cast(value as decimal(18,2))) as double) as spend,
       cast(count(case when event_type = 'click' then 1 end) as bigint) as clicks
from events where event_type in ('click','error') group by 1, 2, 3, 4
union all
select concat('d', cast(case when user_id % 3 = 0 then 0 else user_id % 40 end as string)),
       case when user_id % 3 <> 0 and user_id % 40 = 2 then ''
            when user_id % 3 = 0 or user_id % 40 > 2 then 'Display' end,
       concat('w', cast(user_id % 2 as string)), date_trunc('hour', ts), cast(sum(cast(value as decimal(18,2))) as double),
       cast(count(case when event_type = 'click' then 1 end) as bigint)
from events where event_type in ('click','error') and (user_id % 3 = 0 or user_id % 40 < 36) group by 1, 2, 3, 4
""",
    DAILY: """
select concat('c', cast(user_id % 6 as string)) as campaign_id, cast(ts as date) as date,
       cast(sum(cast(value as decimal(18,2))) as double) as spend
from events where event_type in ('click','error') group by 1, 2
union all
select concat('d', cast(case when user_id % 3 = 0 then 0 else user_id % 40 end as string)), cast(ts as date), cast(sum(cast(value as decimal(18,2))) as double)
from events where event_type in ('click','error') and (user_id % 3 = 0 or user_id % 40 < 36) group by 1, 2
""",
    FUNNEL: """
select concat('c', cast(user_id % 6 as string)) as campaign_id,
       concat('/lp/', cast(user_id % 4 as string)) as page, cast(ts as date) as date,
       case when event_type = 'view' and not (user_id % 4 = 0 and cast(ts as date) >= date '2024-01-29')
            then 'loader' else 'form' end as interaction_type,
       cast(count(distinct user_id) as bigint) as users_reached_step
from events where event_type in ('view','signup') group by 1, 2, 3, 4
union all
select concat('d', cast(case when user_id % 3 = 0 then 0 else user_id % 40 end as string)), concat('/lw/', cast(user_id % 4 as string)), cast(ts as date),
       case when event_type = 'view' then 'loader' else 'form' end, cast(count(distinct user_id) as bigint)
from events where event_type = 'view' or (event_type = 'signup' and user_id % 5 < 2) group by 1, 2, 3, 4
""",
}

# Alert configuration of the fixture queries, for the verticals that events name by user. v0 and w0 run every alert on
# learned benchmarks; v1 runs campaign alerts on fixed thresholds and vertical alerts on fixed thresholds with the
# automated flag set; v2 and v3 are configured but have no campaigns, and v3 leaves out what has a default.
CONFIG_SQL = """
select concat('v', cast(k.k as string)) as vertical_name, c.alert_name,
       cast(c.base as double) as base, cast(c.pct as double) as pct, cast(c.auto as boolean) as auto
from (select distinct user_id % 4 as k from events) k
join (values
  (0, 'volumeDrop', null, null, true), (0, 'flowInterruption', null, null, true),
  (0, 'highLpAbandonment', null, null, true), (0, 'highCPA', 1.0, 0, true),
  (0, 'performanceDecline', 1.0, null, true), (0, 'fbToClickout', 1.0, null, true),
  (0, 'clickoutToConversion', 0.5, null, true),
  (1, 'volumeDrop', 2.0, 50, true), (1, 'flowInterruption', 30.0, null, true),
  (1, 'highLpAbandonment', 0.5, 10, true), (1, 'highCPA', 1.0, 20, false),
  (1, 'performanceDecline', 1.0, 0, false), (1, 'fbToClickout', 1.0, null, false),
  (1, 'clickoutToConversion', 0.5, 5, null),
  (2, 'volumeDrop', 5.0, null, true), (2, 'flowInterruption', 30.0, null, true), (2, 'highCPA', 10.0, null, false),
  (3, 'volumeDrop', 5.0, null, null), (3, 'flowInterruption', null, null, true), (3, 'fbToClickout', 0.25, null, null)
) as c(k, alert_name, base, pct, auto) on k.k = c.k
union all
select concat('w', cast(k.k as string)), c.alert_name, cast(c.base as double), cast(c.pct as double), cast(c.auto as boolean)
from (select distinct user_id % 2 as k from events) k
join (values
  (0, 'volumeDrop', null, null, true), (0, 'flowInterruption', null, null, true),
  (0, 'highLpAbandonment', null, null, true), (0, 'highCPA', 1.0, 0, true),
  (0, 'performanceDecline', 1.0, null, true), (0, 'fbToClickout', 1.0, null, true),
  (0, 'clickoutToConversion', 0.5, null, true),
  (1, 'volumeDrop', 2.0, 50, true), (1, 'flowInterruption', 30.0, null, true),
  (1, 'highLpAbandonment', 0.1, 0, true), (1, 'highCPA', 1000000.0, 0, false),
  (1, 'performanceDecline', 0.0, 0, false), (1, 'fbToClickout', 100.0, null, false),
  (1, 'clickoutToConversion', 0.5, 5, null)
) as c(k, alert_name, base, pct, auto) on k.k = c.k
"""
# --- End of fixed values ---


def fixture_facts(spark: SparkSession, sf_dir: str, store: bool = False) -> Facts:
    """The four fact views over ``<sf_dir>/events.parquet``.

    ``store=True`` writes them once as Parquet tables under the checkpoint
    folder (when the session names one), so the checks read stored fact
    tables with real scans and pushdown, as they would in production.
    """
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    save = Materializer(spark, "fixture-facts") if store else (lambda df, _: df)
    names = list(VIEW_SQL)
    views = [spark.sql(VIEW_SQL[name].replace("from events", "from {events}"), events=events) for name in names]
    stored = run_concurrently([lambda v=v, n=n: save(v, n) for v, n in zip(views, names)], threads=4, spark=spark)
    return facts_from_frames(dict(zip(names, stored)))


def fixture_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested configuration document of the verticals in ``<sf_dir>/events.parquet``."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    flat = spark.sql(CONFIG_SQL.replace("from events", "from {events}"), events=events)
    settings = F.struct(F.col("base").alias("globalBaseThreshold"), F.col("pct").alias("globalPercent"),
                        F.col("auto").alias("automated"))
    return flat.groupBy("vertical_name").agg(
        F.map_from_entries(F.collect_list(F.struct("alert_name", settings))).alias("alerts"))
