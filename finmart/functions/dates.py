"""Calendar attributes (English labels, Sunday = 0 week-day numbering)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week_sunday0(d) -> Column:
    """0 = Sunday … 6 = Saturday (Spark's dayofweek is 1 = Sunday)."""
    return (F.dayofweek(_col(d)) - 1).cast("int")


def is_weekday(d) -> Column:
    return ~day_of_week_sunday0(d).isin(0, 6)


def month_short_name(d) -> Column:
    return F.date_format(_col(d), "MMM")


def month_long_name(d) -> Column:
    return F.date_format(_col(d), "MMMM")


def day_short_name(d) -> Column:
    return F.date_format(_col(d), "EEE")


def day_long_name(d) -> Column:
    return F.date_format(_col(d), "EEEE")


def year_quarter_key(d) -> Column:
    """YYYYQ as int (year text followed by the quarter digit)."""
    d = _col(d)
    return (F.year(d) * 10 + F.quarter(d)).cast("int")
