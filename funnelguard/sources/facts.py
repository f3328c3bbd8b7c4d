"""The four fact tables the checks read, loaded lazily and schema-checked.

Nothing is cached here: each check filters the raw scan by its own time
window, and Catalyst pushes those ranges and the column pruning into the
Parquet reader. Caching the whole tables (as a driver loop would) would
hide the scans from pushdown.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FACT_COLUMNS, check_columns

HOURLY = "hourly_ad_performance_metrics"
DAILY = "daily_ad_performance_metrics"
SESSIONS = "sessions_full_lifecycle"
FUNNEL = "daily_actions_funnel"
FACT_TABLES = (HOURLY, DAILY, SESSIONS, FUNNEL)


@dataclass(frozen=True)
class Facts:
    hourly: DataFrame
    daily: DataFrame
    sessions: DataFrame
    funnel: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {HOURLY: self.hourly, DAILY: self.daily, SESSIONS: self.sessions, FUNNEL: self.funnel}


def facts_from_frames(frames: Mapping[str, DataFrame], check: bool = True) -> Facts:
    """Wrap four DataFrames (keyed by table name), keeping only the declared columns."""
    picked = {}
    for name in FACT_TABLES:
        df = frames[name]
        if check:
            check_columns(df, name)
        picked[name] = df.select(*[F.to_date(c).alias(c) if c == "date" and isinstance(df.schema[c].dataType, T.StringType)
                                   else F.col(c) for c in FACT_COLUMNS[name]])
    return Facts(picked[HOURLY], picked[DAILY], picked[SESSIONS], picked[FUNNEL])


def load_facts(spark: SparkSession, location: str | Mapping[str, str], fmt: str = "table") -> Facts:
    """Load the fact tables.

    ``fmt='table'``: ``location`` is a catalog prefix (``"db"`` →
    ``db.hourly_ad_performance_metrics`` ...) or a mapping table → name.
    Otherwise ``location`` is a directory (``<dir>/<table>`` or
    ``<dir>/<table>.parquet``) or a mapping table → path read with ``fmt``.
    """
    frames = {}
    for name in FACT_TABLES:
        if isinstance(location, Mapping):
            where = location[name]
        elif fmt == "table":
            where = f"{location}.{name}" if location else name
        else:
            where = f"{location.rstrip('/')}/{name}"
        if fmt == "table":
            frames[name] = spark.table(where)
        else:
            frames[name] = _read_path(spark, where, fmt)
    return facts_from_frames(frames)


def _read_path(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    try:
        return reader.load(path)
    except AnalysisException:  # no such path
        if fmt == "parquet" and not path.endswith(".parquet"):
            return reader.load(path + ".parquet")
        raise


def row_counts(facts: Facts) -> DataFrame:
    """Row count of each fact table as (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in facts.by_name().items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
