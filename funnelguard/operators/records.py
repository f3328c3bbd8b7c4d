"""K1: the fixed 12-field alert record, as a struct column built from a metric row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ALERT


def _col(value: str | Column | None) -> Column:
    if value is None:
        return F.lit(None)
    return F.col(value) if isinstance(value, str) else value


def record(alert_name: str, *, value: str | Column, value_timeframe: str,
           benchmark: str | Column, benchmark_timeframe: str,
           campaign: bool = False, landing_page: str | None = None,
           spend: str | Column | None = None, leads: str | Column | None = None,
           base_threshold: str | Column | None = None) -> Column:
    """The alert of the current row; fields that do not apply are NULL (rendered "N/A")."""
    fields = {
        "alert_name": F.lit(alert_name),
        "vertical_name": F.col("vertical_name"),
        "campaign_name": _col("campaign_name" if campaign else None),
        "campaign_id": _col("campaign_id" if campaign else None),
        "calculated_value": _col(value),
        "calculated_value_timeframe": F.lit(value_timeframe),
        "benchmark": _col(benchmark),
        "benchmark_timeframe": F.lit(benchmark_timeframe),
        "landing_page": _col(landing_page),
        "spend": _col(spend),
        "leads": _col(leads),
        "base_threshold": _col(base_threshold),
    }
    return F.struct(*[fields[name].cast(type_name).alias(name) for name, type_name in _FIELD_TYPES])


# (name, type name) of the record fields; casting by name avoids a JVM type parse per column
_FIELD_TYPES = tuple((f.name, f.dataType.simpleString()) for f in ALERT.fields)
