"""Aggregate and ratio expressions shared by the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def money_sum(col: str | Column) -> Column:
    """Sum of a money column in its own type (DOUBLE or DECIMAL), returned as DOUBLE."""
    return F.sum(col).cast("double")


def any_row(cond: Column) -> Column:
    """True if at least one row of the group satisfies ``cond``."""
    return F.coalesce(F.max(cond), F.lit(False))


def sum_if_rows(cond: Column, rows: str, value: str) -> Column:
    """Over rollup rows: sum of ``value`` where ``cond``; NULL unless the matching ``rows`` counts add up to > 0.

    Rollup rows carry the number of fact rows they stand for, so this is
    ``count``/``sum`` over the fact rows of a window with the outer-join
    meaning of a window without rows.
    """
    return F.when(F.sum(F.when(cond, F.col(rows))) > 0, F.sum(F.when(cond, F.col(value))))


def ratio(numerator: str, denominator: str, on_zero: float) -> Column:
    """``num / den``; ``on_zero`` when the denominator is 0; NULL if either is NULL."""
    den = F.col(denominator)
    return F.when(den == 0, F.lit(on_zero)).otherwise(F.col(numerator) / den).cast("double")


def fired(cond: Column) -> Column:
    """A NULL comparison never fires."""
    return F.coalesce(cond, F.lit(False))


def effective_threshold(base: str, percent: str) -> Column:
    """``base * (1 + pct/100)`` when pct > 0, else base."""
    pct = F.col(percent)
    return (F.when(pct.isNotNull() & (pct > 0), F.col(base) * (1 + pct / 100))
            .otherwise(F.col(base)).cast("double"))
