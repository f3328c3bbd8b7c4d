"""One explicit clock per run, and half-open time windows as pushdown-friendly predicates.

Every window is ``[lo, hi)`` with literal bounds computed on the driver from
``as_of``, so Catalyst sees plain comparisons of a raw column with constants
and pushes them to the Parquet scan. Bounds are typed like the column they
are compared with (TIMESTAMP or TIMESTAMP_NTZ) so the column is never
wrapped in a cast. Calendar parts (day, hour, weekday) are those of UTC and
a TIMESTAMP_NTZ column holds UTC wall-clock time; nothing depends on the
time zone of the session.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_utc_naive(value: datetime | str) -> datetime:
    """Normalise an as_of value (aware or naive datetime, or ISO text) to naive UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


@dataclass(frozen=True)
class Clock:
    """The instant every window of one run is measured from."""

    now: datetime

    @classmethod
    def at(cls, as_of: datetime | str) -> "Clock":
        return cls(to_utc_naive(as_of))

    @property
    def today(self) -> datetime:
        return self.now.replace(hour=0, minute=0, second=0, microsecond=0)

    @property
    def today_date(self) -> date:
        return self.now.date()

    @property
    def hour(self) -> int:
        return self.now.hour

    @property
    def dayofweek(self) -> int:
        """Spark's convention: 1 = Sunday ... 7 = Saturday."""
        return self.now.isoweekday() % 7 + 1

    @property
    def offset_us(self) -> int:
        """Microseconds of as_of past its clock hour."""
        return micros(self.now) % 3_600_000_000

    def us(self, value: datetime) -> int:
        return micros(value)

    def ago(self, **delta: float) -> datetime:
        return self.now - timedelta(**delta)

    def days_before_today(self, days: int) -> datetime:
        return self.today - timedelta(days=days)


_EPOCH = datetime(1970, 1, 1)


def micros(value: datetime) -> int:
    """Epoch microseconds of a naive UTC datetime."""
    return (value - _EPOCH) // timedelta(microseconds=1)


def _text(value: datetime) -> str:
    return value.strftime("%Y-%m-%d %H:%M:%S.%f")


def ts_lit(value: datetime, like: T.DataType | None = None) -> Column:
    """A timestamp literal typed like ``like`` (TIMESTAMP unless it is NTZ)."""
    if isinstance(like, T.TimestampNTZType):
        return F.lit(_text(value)).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(micros(value)))


def date_lit(value: date | datetime) -> Column:
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(value.isoformat()).cast("date")


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def in_window(df: DataFrame, name: str, lo: datetime | None, hi: datetime | None) -> Column:
    """``lo <= df[name] < hi`` on the raw column; either bound may be None."""
    like = column_type(df, name)
    col = F.col(name)
    cond = col.isNotNull()
    if lo is not None:
        cond = cond & (col >= ts_lit(lo, like))
    if hi is not None:
        cond = cond & (col < ts_lit(hi, like))
    return cond


def in_dates(df: DataFrame, name: str, first: date | datetime, last: date | datetime) -> Column:
    """``first <= date(df[name]) <= last`` for a DATE (or timestamp) column, both ends inclusive."""
    like = column_type(df, name)
    col = F.col(name)
    if isinstance(like, (T.TimestampType, T.TimestampNTZType)):
        lo = datetime.combine(_as_date(first), datetime.min.time())
        hi = datetime.combine(_as_date(last), datetime.min.time()) + timedelta(days=1)
        return col.isNotNull() & (col >= ts_lit(lo, like)) & (col < ts_lit(hi, like))
    return col.isNotNull() & (col >= date_lit(first)) & (col <= date_lit(last))


def _as_date(value: date | datetime) -> date:
    return value.date() if isinstance(value, datetime) else value


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a TIMESTAMP or (as UTC) a TIMESTAMP_NTZ column."""
    if isinstance(column_type(df, name), T.TimestampNTZType):
        since = F.col(name) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")
    return F.unix_micros(F.col(name).cast("timestamp"))


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole epoch seconds (floored) of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.floor(epoch_micros(df, name) / F.lit(1_000_000)).cast("long")


def utc_date(df: DataFrame, name: str) -> Column:
    """The UTC date of a DATE, TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(column_type(df, name), T.DateType):
        return F.col(name)
    days = F.floor(epoch_micros(df, name) / F.lit(86_400_000_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def format_ts(col: Column, micros: bool = False) -> Column:
    """Render an instant as text in the session zone (stable across engines)."""
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS" if micros else "yyyy-MM-dd HH:mm:ss"
    return F.date_format(col.cast("timestamp"), pattern)
