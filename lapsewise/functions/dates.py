"""Calendar expressions (PostgreSQL conventions where they differ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """YYYYMMDD integer key of a date."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week_sunday0(d) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(_col(d)) - 1).cast("int")


def month_name(d) -> Column:
    return F.date_format(_col(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_col(d), "EEEE")


def is_month_start(d) -> Column:
    d = _col(d)
    return d == F.trunc(d, "month")


def is_month_end(d) -> Column:
    d = _col(d)
    return d == F.last_day(d)


def parse_date(c, dtype: T.DataType | None = None) -> Column:
    """Date from a string (ISO date or timestamp text), date or timestamp.

    Unparseable text gives NULL (the NOT NULL check then reports it); the
    time of day is dropped.  Pass the input ``dtype`` when known: dates and
    timestamps then convert directly.  Text goes through Spark's own date
    cast (``yyyy-MM-dd`` optionally followed by a time), which signals
    failure without raising, unlike pattern-based parsing.
    """
    c = _col(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return c.cast("string").try_cast("date")
