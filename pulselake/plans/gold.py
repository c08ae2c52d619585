"""The heart-rate fact and its star."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions.calendar import minute_of_day, time_of_day
from pulselake.operators import ordered
from pulselake.operators.keys import version_on, versions_by_key
from pulselake.operators.skew import Hot, checked_broadcast, hot_keys, join_back, left_join, split_by_keys
from pulselake.schemas import FCT_HEART_RATE

DAILY_GROUP = ["user_key", "activity_id", "event_date"]


def daily_stats() -> dict[str, Column]:
    return {"max_heart_rate": F.max("heart_rate"), "min_heart_rate": F.min("heart_rate"),
            "avg_heart_rate": F.avg("heart_rate")}


def with_date_and_time(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"event_date": F.to_date("event_timestamp"),
                             "event_time": time_of_day(F.col("event_timestamp"))})


def base(hr: DataFrame) -> DataFrame:
    """Readings with the fact's keys."""
    return with_date_and_time(hr.withColumnRenamed("user_id", "user_key"))


def fact_rows(hr: DataFrame, hot: Hot | None = None) -> DataFrame:
    """The fact plus event_timestamp and event_id.

    No dimension is joined here: a left join to a dimension that is unique on
    its key neither adds nor drops a row, and the fact shows none of their
    columns. ``star`` joins them where attributes are wanted.
    """
    rows = ordered.with_previous_and_stats(
        hr.withColumnRenamed("user_id", "user_key"),
        "event_timestamp", "event_id", "heart_rate", "previous_heart_rate",
        DAILY_GROUP, {"event_date": F.to_date("event_timestamp")}, daily_stats(), hot)
    return rows.withColumn("event_time", time_of_day(F.col("event_timestamp")))


def fct_heart_rate(hr: DataFrame, hot: Hot | None = None) -> DataFrame:
    return fact_rows(hr, hot).select(*FCT_HEART_RATE.names)


def cells_by_day(rows: DataFrame) -> DataFrame:
    """(event_date, cells): how many shares to cut each day into, in proportion
    to its readings, so that no day weighs on few tasks however much it holds.

    A day has a row here, so the calendar bounds both the collected counts and
    the broadcast."""
    wanted = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    return rows.sparkSession.createDataFrame(
        [(r["event_date"], -(-wanted * r["n"] // total)) for r in counts], "event_date date, _cells long")


def _laid_out_by_day(rows: DataFrame, before: DataFrame) -> DataFrame:
    """Previous value and statistics with one shuffle that also suits a write by
    day: rows are gathered by day and by cell, a share of the users.

    ``before`` holds, per user and day, the value before that day. It joins the
    rows as one more row that sorts first, which spares a real join.
    """
    cells = F.broadcast(cells_by_day(rows).withColumnRenamed("event_date", "_day"))
    cell = F.pmod(F.xxhash64("user_key"), F.coalesce("_cells", F.lit(1)))
    both = (rows.withColumn("_reading", F.lit(True))
            .unionByName(before.withColumn("_reading", F.lit(False)), allowMissingColumns=True)
            .join(cells, F.col("event_date").eqNullSafe(F.col("_day")), "left")
            .withColumn("_cell", cell).drop("_cells", "_day").repartition("event_date", "_cell"))
    user_day = ["event_date", "_cell", "user_key"]
    order = Window.partitionBy(*user_day).orderBy("_reading", "event_timestamp", "event_id")
    group = Window.partitionBy(*user_day, "activity_id", "_reading")
    carried = {"previous_heart_rate": F.lag("heart_rate").over(order)}
    if "user_sk" in before.columns:  # looked up once for each user and day
        carried["user_sk"] = F.first("user_sk").over(order)
    return (both.withColumns(carried)
            .withColumns({name: c.over(group) for name, c in daily_stats().items()})
            .filter("_reading").drop("_reading", "_cell"))


def in_scope(day: Column, since: datetime.date | None, days: list[datetime.date] | None) -> Column:
    """Whether a day is one of ``days`` or, without such a list, ``since`` or later."""
    if days is not None:
        return F.coalesce(day.isin(days), F.lit(False))
    return F.coalesce(day >= F.lit(since), F.lit(False)) if since else F.lit(True)


def user_days(last: DataFrame, since: datetime.date | None = None,
              days: list[datetime.date] | None = None) -> DataFrame:
    """Each user's days in scope: (user_key, event_date, last_heart_rate, before), the last value of the
    day and the last reading of the user's day before it, NULL on the first one.

    ``last`` has a row for each user and day (``silver.last_readings``); of users without a
    day in scope none is looked at.
    """
    day = F.to_date("event_timestamp")
    if since or days is not None:
        here = last.filter(in_scope(day, since, days)).select("user_id").distinct()
        last = last.join(here, "user_id", "left_semi")
    # A user's days, one row each: a number the calendar bounds.
    earlier = Window.partitionBy("user_id").orderBy("event_timestamp", "event_id")
    return (last.select(F.col("user_id").alias("user_key"), day.alias("event_date"),
                        F.col("heart_rate").alias("last_heart_rate"),
                        F.lag(F.struct("event_timestamp", "event_id", "heart_rate")).over(earlier).alias("before"))
            .filter(in_scope(F.col("event_date"), since, days)))


def fact_by_day(hr: DataFrame, last: DataFrame, since: datetime.date | None = None,
                hot: Hot | None = None, days: list[datetime.date] | None = None,
                users: DataFrame | None = None, activities: DataFrame | None = None) -> DataFrame:
    """The fact of the readings in ``hr``, ready to be written by day.

    ``last`` has each user's last reading of each day (``silver.last_readings``)
    over all days, also those that ``hr`` leaves out: it holds the days in ``days`` or, without
    them, from ``since`` on. ``users`` and ``activities`` are histories (``silver.users_history``);
    with them each reading carries the keys of the versions valid on its day.
    """
    hot = hot_keys(hr, "user_id") if hot is None else hot
    day = F.to_date("event_timestamp").alias("event_date")
    before = user_days(last, since, days)
    names = [*FCT_HEART_RATE.names]
    if users is not None:
        versions = versions_by_key(users, "user_id", "user_sk").withColumnRenamed("user_id", "user_key")
        before = (left_join(before, versions, "user_key", hot)
                  .withColumn("user_sk", version_on(F.col("event_date"), F.col("versions"))).drop("versions"))
        names.append("user_sk")
    rows = hr.withColumnRenamed("user_id", "user_key").withColumn("event_date", day)
    cold, _ = split_by_keys(rows, "user_key", hot.keys)
    cold_before, hot_before = split_by_keys(before, "user_key", hot.keys)
    seeds = cold_before.select("user_key", "event_date", "before.heart_rate", *names[len(FCT_HEART_RATE.names):])
    fact = (_laid_out_by_day(cold, seeds)
            .withColumn("event_time", time_of_day(F.col("event_timestamp"))).select(*names))
    if hot:
        _, hot_rows = split_by_keys(hr, "user_id", hot.keys)
        scoped = since is not None or days is not None
        if scoped:  # a user's last reading before each run of days that is in scope
            outside = hot_before.filter(~in_scope(F.to_date("before.event_timestamp"), since, days))
            carried = outside.filter("before IS NOT NULL").select(F.col("user_key").alias("user_id"), "before.*")
            hot_rows = hot_rows.unionByName(carried, allowMissingColumns=True)
        hot_fact = fct_heart_rate(hot_rows, hot)
        if scoped:
            hot_fact = hot_fact.filter(in_scope(F.col("event_date"), since, days))
        if users is not None:  # a row for each hot user and day
            keys = hot_before.select("user_key", "event_date", "user_sk")
            hot_fact = join_back(hot_fact, keys, ["user_key", "event_date"])
        fact = fact.unionByName(hot_fact.hint("rebalance", F.col("event_date")))
    if activities is not None:
        versions = checked_broadcast(versions_by_key(activities, "activity_id", "activity_sk"))
        fact = (fact.join(versions, "activity_id", "left")
                .withColumn("activity_sk", version_on(F.col("event_date"), F.col("versions")))
                .select(*names, "activity_sk"))
    return fact


# Star joins -------------------------------------------------------------------
# All keep every reading. The date and time dimensions have a proven size (days
# of the calendar, minutes of a day) and are broadcast. Activities are broadcast
# after a count. Users are not hinted: Spark broadcasts them if their measured
# size allows, and readings of hot users are joined apart.

def join_users(rows: DataFrame, users: DataFrame, columns: list[str],
               hot: Hot | None = None) -> DataFrame:
    dim = users.select(F.col("user_id").alias("user_key"), *columns)
    return left_join(rows, dim, "user_key", hot)


def join_activities(rows: DataFrame, activities: DataFrame) -> DataFrame:
    dim = checked_broadcast(activities.select("activity_id", "activity_name"))
    return rows.join(dim, "activity_id", "left")


def join_date(rows: DataFrame, dates: DataFrame, columns: list[str]) -> DataFrame:
    dim = dates.select(F.col("date_day").alias("event_date"), *columns)
    return rows.join(F.broadcast(dim), "event_date", "left")


def join_time(rows: DataFrame, times: DataFrame, columns: list[str],
              ts: str = "event_timestamp") -> DataFrame:
    """The time dimension has one row per minute, so the key is the minute."""
    dim = times.select(F.col("time_of_day").alias("_minute"), *columns)
    return rows.withColumn("_minute", minute_of_day(F.col(ts))).join(
        F.broadcast(dim), "_minute", "left").drop("_minute")


def star(rows: DataFrame, users: DataFrame, activities: DataFrame, dates: DataFrame,
         times: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Readings with the attributes of all four dimensions. The broadcasts come
    first, so that only the users join can need a shuffle."""
    rows = join_date(rows, dates, ["day_name", "is_weekend"])
    rows = join_time(rows, times, ["time_category"])
    rows = join_activities(rows, activities)
    return join_users(rows, users, ["gender", "race", "address_country"], hot)
