"""The per-vertical alert configuration document, as a typed DataFrame.

Document shape (a JSON list)::

    [{"vertical_name": "v0",
      "alerts": {"highCPA": {"globalBaseThreshold": 40.0,
                             "globalPercent": 10,
                             "automated": false}, ...}}, ...]

The document is small by nature (verticals x seven alerts), so the
exploded form is safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ALERT_CONFIG

EXPLODED_COLUMNS = ("vertical_name", "alert_name", "base_threshold", "percent_increase", "automated")


def config_frame(spark: SparkSession, document: Iterable[Mapping] | str | DataFrame | None) -> DataFrame:
    """Nested config (vertical_name, alerts map) from a list of dicts, a JSON path, or a DataFrame.

    ``None`` (a failed fetch) gives an empty config, which raises no alert. A
    document that cannot be read whole, or has a value of another type than
    the schema's, is an error.
    """
    if document is None:
        return spark.createDataFrame([], ALERT_CONFIG)
    if isinstance(document, DataFrame):
        return document
    if isinstance(document, str):
        return spark.read.schema(ALERT_CONFIG).option("multiLine", "true").option("mode", "FAILFAST").json(document)
    rows = []
    for project in document:
        alerts = {}
        for name, settings in (project.get("alerts") or {}).items():
            settings = settings or {}
            alerts[name] = (
                _float(settings.get("globalBaseThreshold")),
                _float(settings.get("globalPercent")),
                None if settings.get("automated") is None else bool(settings.get("automated")),
            )
        rows.append((project.get("vertical_name"), alerts))
    return spark.createDataFrame(rows, ALERT_CONFIG)


def _float(value):
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ValueError(f"a threshold must be a number: {value!r}")
    return float(value)


def check_verticals(config: DataFrame) -> None:
    """Raise an error if an entry has no vertical, or two entries have the same."""
    bad = config.groupBy("vertical_name").count().where("vertical_name IS NULL OR count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"verticals without a name or with several entries: {[r.vertical_name for r in bad]}")


def explode_config(config: DataFrame) -> DataFrame:
    """One row per (vertical, alert) with the documented defaults applied.

    Missing ``globalPercent`` is 0 and missing ``automated`` is false.
    """
    return (config
            .select("vertical_name", F.explode("alerts").alias("alert_name", "s"))
            .select("vertical_name", "alert_name",
                    F.col("s.globalBaseThreshold").cast("double").alias("base_threshold"),
                    F.coalesce(F.col("s.globalPercent"), F.lit(0.0)).cast("double").alias("percent_increase"),
                    F.coalesce(F.col("s.automated"), F.lit(False)).alias("automated")))
