"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c, ColumnOrName


def to_day(c: ColumnOrName) -> Column:
    """Driver timestamps are TIMESTAMP_NTZ; work in DATE."""
    return _c(c).cast("date")


def month_start(c: ColumnOrName) -> Column:
    """``to_period('M').start_time`` -> first day of the month."""
    return F.trunc(_c(c).cast("date"), "month")


def planting_bound(year: ColumnOrName) -> Column:
    """31 December of the year before planting."""
    return F.make_date(_c(year) - 1, F.lit(12), F.lit(31))


def next_month(c: ColumnOrName) -> Column:
    """Calendar successor of a month."""
    return F.add_months(_c(c), 1)


def lookback_start(asof: ColumnOrName, years: int) -> Column:
    """P20: as-of date minus ``years`` x 365 days (explicit as-of date)."""
    return F.date_sub(_c(asof), 365 * years)


def parse_day(c: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """``strptime`` -> DATE; bad text -> NULL."""
    return F.try_to_date(_c(c), F.lit(fmt)) if hasattr(F, "try_to_date") else F.to_date(_c(c), fmt)
