"""The research questions, on the star schema.

Readings are aggregated per user before a dimension is joined: what is shuffled
is then a row per user and activity, and a user with very many readings counts
as little as any other. Sums and counts are carried, so averages stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions.calendar import season, time_category
from pulselake.operators.skew import checked_broadcast


def daily_hr_stats(hr: DataFrame) -> DataFrame:
    return (hr.groupBy("user_id", "activity_id", F.to_date("event_timestamp").alias("event_date"))
            .agg(F.max("heart_rate").alias("max_heart_rate"), F.min("heart_rate").alias("min_heart_rate"),
                 F.avg("heart_rate").alias("avg_heart_rate")))


def first_event_date(hr: DataFrame) -> DataFrame:
    return hr.groupBy("user_id").agg(F.min(F.to_date("event_timestamp")).alias("first_date"))


def first_event_per_user(hr: DataFrame) -> DataFrame:
    """Each user's first reading, by a map-side combined minimum."""
    first = F.min(F.struct("event_timestamp", "event_id", "heart_rate", "activity_id")).alias("f")
    return hr.groupBy("user_id").agg(first).select("user_id", "f.*")


def user_timeline(hr: DataFrame) -> DataFrame:
    """All readings in order. The range partitioning is by user and time, so
    one user's readings may spread over tasks."""
    return hr.orderBy("user_id", "event_timestamp", "event_id")


def _average(digits: int = 6) -> Column:
    return F.round(F.sum("total") / F.sum("readings"), digits)


def by_activity_and_demographic(hr: DataFrame, users: DataFrame, activities: DataFrame) -> DataFrame:
    """How heart rate varies by activity, demographic and region, with
    subtotals. ``level`` is 0 for the finest rows, 7 for the grand total."""
    per_user = hr.groupBy("user_id", "activity_id").agg(
        F.count("heart_rate").alias("readings"), F.sum("heart_rate").alias("total"),
        F.min("heart_rate").alias("low"), F.max("heart_rate").alias("high"))
    who = users.select("user_id", "gender", F.col("address_country").alias("region"))
    return (per_user.join(checked_broadcast(activities.select("activity_id", "activity_name")), "activity_id", "left")
            .join(who, "user_id", "left")
            .rollup("activity_name", "gender", "region")
            .agg(F.grouping_id().cast("int").alias("level"), F.sum("readings").alias("readings"),
                 F.min("low").alias("min_heart_rate"), F.max("high").alias("max_heart_rate"),
                 _average().alias("avg_heart_rate")))


def seasonal(hr: DataFrame, period: str = "month") -> DataFrame:
    """Average per user and period, with the change since the user's previous
    period. The window holds a user's periods, not readings."""
    start = F.date_trunc(period, "event_timestamp").cast("date").alias("period_start")
    per_period = hr.groupBy("user_id", start).agg(
        F.count("heart_rate").alias("readings"), F.sum("heart_rate").alias("total"))
    average = F.col("total") / F.col("readings")
    w = Window.partitionBy("user_id").orderBy("period_start")
    return per_period.select(
        "user_id", "period_start", season(F.col("period_start")).alias("season"), "readings",
        F.round(average, 6).alias("avg_heart_rate"),
        F.round(average - F.lag(average).over(w), 6).alias("change"))


def activity_likelihood(hr: DataFrame, users: DataFrame, activities: DataFrame) -> DataFrame:
    """Share of each activity among a region's readings in a time category."""
    per_user = hr.groupBy("user_id", "activity_id",
                          time_category(F.hour("event_timestamp")).alias("time_category")
                          ).agg(F.count(F.lit(1)).alias("n"))
    where = users.select("user_id", F.col("address_country").alias("region"))
    counts = (per_user.join(checked_broadcast(activities.select("activity_id", "activity_name")), "activity_id", "left")
              .join(where, "user_id", "left")
              .groupBy("region", "time_category", "activity_name").agg(F.sum("n").alias("readings")))
    w = Window.partitionBy("region", "time_category")
    return counts.withColumn(
        "likelihood", F.round(F.col("readings") / F.sum("readings").over(w), 6))


def prior_period(daily: DataFrame, days: int = 1) -> DataFrame:
    """Daily statistics beside those ``days`` earlier (365: a year, 364: same
    weekday a year back). A range frame finds the earlier day, which spares the
    join of the aggregate with itself."""
    number = F.datediff("event_date", F.lit("1970-01-01").cast("date"))
    w = (Window.partitionBy("user_id", "activity_id").orderBy(number).rangeBetween(-days, -days))
    prior = F.first("avg_heart_rate").over(w)
    return daily.select(
        "user_id", "activity_id", "event_date", "avg_heart_rate",
        prior.alias("prior_avg_heart_rate"),
        F.round(F.col("avg_heart_rate") - prior, 6).alias("change"))
