"""Calendar dimension (``dim_date``) generated inside Spark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import functions as LF


def _calendar_columns(day) -> list:
    return [
        LF.date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        LF.month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        LF.day_of_week_sunday0(day).alias("day_of_week"),
        LF.day_name(day).alias("day_name"),
        LF.day_of_week_sunday0(day).isin(0, 6).alias("is_weekend"),
        LF.is_month_start(day).alias("is_month_start"),
        LF.is_month_end(day).alias("is_month_end"),
    ]


def _explode_days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("_d")
    )
    return days.select(*_calendar_columns(F.col("_d")))


def dim_date(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("_lo"), F.lit(str(end)).cast("date").alias("_hi")
    )
    return _explode_days(bounds)


def dim_date_covering(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar spanning min..max of ``date_col`` (bounds found by an aggregate).

    The row count is bounded by the date span (about 366 rows a year), so the
    result is safe to broadcast into fact joins.
    """
    bounds = df.agg(
        F.min(date_col).cast("date").alias("_lo"), F.max(date_col).cast("date").alias("_hi")
    ).where(F.col("_lo").isNotNull())
    return _explode_days(bounds)
