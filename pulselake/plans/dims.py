"""Date and time-of-day dimensions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.functions.calendar import day_of_week, is_weekend, time_category, time_of_day

FIRST_DAY = datetime.date(2024, 1, 1)
LAST_DAY = datetime.date(2026, 12, 31)


def _date_columns(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(
        d.alias("date_day"), d,
        F.date_sub(d, 1).alias("prior_date_day"),
        F.date_add(d, 1).alias("next_date_day"),
        F.date_sub(d, 365).alias("prior_year_date_day"),
        F.date_sub(d, 364).alias("prior_year_over_year_date_day"),
        F.trunc(d, "YEAR").alias("year_start_date"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end_date"),
        F.day(d).alias("day"),
        day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"))


def dim_date(spark: SparkSession, first: datetime.date = FIRST_DAY,
             last: datetime.date = LAST_DAY) -> DataFrame:
    """One row per day of the range."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _date_columns(bounds.select(F.explode(F.sequence("first", "last")).alias("date")))


def dim_date_covering(df: DataFrame, column: str) -> DataFrame:
    """The date dimension for the whole years that ``column`` spans."""
    day = F.to_date(column)
    bounds = df.agg(F.trunc(F.min(day), "YEAR").alias("first"), F.year(F.max(day)).alias("y"))
    last = F.make_date(F.col("y"), F.lit(12), F.lit(31))
    return _date_columns(bounds.select(F.explode(F.sequence(F.col("first"), last)).alias("date")))


def with_month_end(days: DataFrame) -> DataFrame:
    """The last day of each day's month beside the documented columns."""
    return days.withColumn("month_end_date", F.last_day("date_day"))


def calendar_of(df: DataFrame, column: str, first: datetime.date = FIRST_DAY, last: datetime.date = LAST_DAY) -> DataFrame:
    """The date dimension from ``first`` to ``last``, extended by the whole years before and after
    that ``column`` has days in. No row of ``df`` but its least and greatest day is needed."""
    day = F.to_date(column)
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    bounds = ends.select(
        F.least(F.lit(first), F.trunc("lo", "YEAR")).alias("first"),
        F.greatest(F.lit(last), F.make_date(F.year("hi"), F.lit(12), F.lit(31))).alias("last"))
    return with_month_end(_date_columns(bounds.select(F.explode(F.sequence("first", "last")).alias("date"))))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    ts = F.timestamp_seconds(F.col("id") * 60)
    return spark.range(0, 24 * 60, 1, 1).select(
        time_of_day(ts).alias("time_of_day"),
        F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second"),
        time_category(F.hour(ts)).alias("time_category"))
