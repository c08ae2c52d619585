"""The named queries, over the test tables: (session, table directory) -> frame."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pulselake import schemas
from pulselake.functions import bands, calendar, clean
from pulselake.operators import keys, ordered, quality
from pulselake.operators.skew import hot_keys
from pulselake.plans import analytics, dims, gold, refresh, silver
from pulselake.registry import Lake
from pulselake.session import shared_dir
from pulselake.sources import raw, testdata
from pulselake.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# A second delivery begins on this day in the incremental and streaming queries.
SECOND_DELIVERY = "2024-01-16"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def _hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.heart_rate(testdata.raw_heart_rate(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.users(testdata.raw_users(spark, sf_dir))


def _activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.activities(testdata.raw_activities(spark, sf_dir))


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps as zone-free values, for comparison outside Spark."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz")
                           for f in df.schema.fields if f.dataType.simpleString() == "timestamp"})


def _lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, shared_dir(spark, label))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the faults a raw feed shows: missing users, broken
    documents, coordinates off the globe."""
    meta = F.when(F.col("heart_rate") < 60, F.substring("meta", 1, 20)).otherwise(F.col("meta"))
    rows = testdata.raw_heart_rate(spark, sf_dir).select(
        "event_id", F.when(F.col("heart_rate") <= 190, F.col("user_id")).alias("user_id"),
        "heart_rate", "timestamp", meta.alias("meta"))
    parsed = clean.parse_meta(F.col("meta"))
    return rows.select(
        "event_id", "user_id", "heart_rate",
        clean.epoch_to_timestamp(F.col("timestamp")).alias("event_timestamp"),
        parsed["activity_id"].alias("activity_id"),
        (parsed["location"]["latitude"] * 2).alias("latitude"),
        (parsed["location"]["longitude"] * 2).alias("longitude"))


# Sources and sinks ------------------------------------------------------------

@query
def scan_table(spark, sf_dir):
    lake = _lake(spark, "scan")
    lake.write(testdata.raw_users(spark, sf_dir), "bronze", "raw_users")
    return lake.read("bronze", "raw_users")


@query
def write_roundtrip(spark, sf_dir):
    lake = _lake(spark, "roundtrip")
    readings = _hr(spark, sf_dir)
    lake.write(readings.filter(F.col("heart_rate") < 100), "silver", "heart_rate_cleaned")
    lake.write(readings.filter(F.col("heart_rate") < 120), "silver", "heart_rate_cleaned")  # replaces
    lake.write(readings.filter(F.col("heart_rate") >= 120), "silver", "heart_rate_cleaned", mode="append")
    return _naive(lake.read("silver", "heart_rate_cleaned"))


@query
def publish_dims(spark, sf_dir):
    lake = _lake(spark, "publish")
    lake.write(_users(spark, sf_dir), "silver", "dim_users")
    lake.write(_activities(spark, sf_dir), "silver", "dim_activities")
    lake.write(dims.dim_date_covering(testdata.table(spark, sf_dir, "orders"), "o_orderdate"),
               "silver", "dim_date")
    lake.write(dims.dim_time(spark), "silver", "dim_time")
    for key in refresh.DIMENSIONS:
        refresh.publish(lake, key)
    names = {"dim_users": "user_id", "dim_activities": "activity_id", "dim_date": "date_day",
             "dim_time": "time_of_day"}
    parts = [lake.read("gold", key).select(F.lit(key).alias("dimension"),
                                           F.col(column).cast("string").alias("member"))
             for key, column in names.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query
def csv_ingest(spark, sf_dir):
    path = shared_dir(spark, "csv")
    testdata.raw_users(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return raw.read_csv(spark, path, schemas.RAW_USER)


@query
def jsonl_ingest(spark, sf_dir):
    path = shared_dir(spark, "jsonl")
    raw.encode_events(testdata.raw_heart_rate(spark, sf_dir)).select("value").write.text(path)
    good, _ = raw.split_corrupt(raw.read_jsonl(spark, path, with_id=True))
    return _naive(silver.heart_rate(good))


@query
def jsonl_corrupt_split(spark, sf_dir):
    path = shared_dir(spark, "corrupt")
    events = testdata.raw_heart_rate(spark, sf_dir)
    value = F.when(F.col("heart_rate") > 180, F.lit("{broken")).otherwise(F.col("value"))
    lines = raw.encode_events(events).withColumn(
        "heart_rate", F.get_json_object("value", "$.heart_rate").cast("bigint"))
    lines.select(value.alias("value")).write.text(path)
    records = raw.read_jsonl(spark, path, with_id=True)
    good, bad = raw.split_corrupt(records)
    return (good.select(F.lit("good").alias("status"), "event_id", "heart_rate")
            .unionByName(bad.select(F.lit("corrupt").alias("status"), "event_id", "heart_rate")))


def _deliver(spark: SparkSession, sf_dir: str, path: str, second: bool) -> None:
    later = F.col("timestamp") >= F.unix_timestamp(F.lit(SECOND_DELIVERY), "yyyy-MM-dd")
    events = testdata.raw_heart_rate(spark, sf_dir).filter(later if second else ~later)
    raw.encode_events(events).select("value").write.mode("append").text(path)


@query
def incremental_append(spark, sf_dir):
    root = shared_dir(spark, "append")
    for second in (False, True):
        _deliver(spark, sf_dir, f"{root}/in", second)
        for _ in range(2):  # the repeat finds no new file
            jobs.incremental_append(spark, f"{root}/in", f"{root}/table", f"{root}/checkpoint", with_id=True)
    return spark.read.parquet(f"{root}/table").select("event_id", "user_id", "heart_rate", "timestamp", "meta")


@query
def encode_events(spark, sf_dir):
    return raw.encode_events(testdata.raw_heart_rate(spark, sf_dir))


@query
def decode_events(spark, sf_dir):
    messages = raw.encode_events(testdata.raw_heart_rate(spark, sf_dir))
    as_bytes = messages.select(F.encode("value", "UTF-8").alias("value"))  # as a topic delivers them
    good, _ = raw.split_corrupt(raw.decode_events(as_bytes, with_id=True))
    return _naive(silver.heart_rate(good))


@query
def decode_topic_messages(spark, sf_dir):
    """Events from messages as a topic delivers them, each with the place it was read at."""
    messages = raw.encode_events(testdata.raw_heart_rate(spark, sf_dir)).select(
        F.encode("value", "UTF-8").alias("value"), F.lit("heartrate").alias("topic"),
        (F.col("key").cast("bigint") % 6).cast("int").alias("partition"),
        F.get_json_object("value", "$.event_id").cast("bigint").alias("offset"),
        F.timestamp_seconds(F.get_json_object("value", "$.timestamp").cast("bigint") + 2).alias("timestamp"))
    good, _ = raw.split_corrupt(raw.decode_events(messages, with_id=True, lineage=True))
    return _naive(good.select("event_id", "user_id", "heart_rate", "_topic", "_partition", "_offset", "_message_time"))


LANDED = ("event_id bigint, user_id bigint, heart_rate bigint, timestamp bigint, meta string, year string,"
          " month string, day string, hour string")


@query
def lake_sink_hourly(spark, sf_dir):
    path = shared_dir(spark, "lake")
    raw.write_lake(testdata.raw_heart_rate(spark, sf_dir), path)
    return spark.read.schema(LANDED).json(path)


# Cleaning ---------------------------------------------------------------------

@query
def silver_users(spark, sf_dir):
    return _users(spark, sf_dir)


@query
def silver_activities(spark, sf_dir):
    return _activities(spark, sf_dir)


@query
def silver_heart_rate(spark, sf_dir):
    return _naive(_hr(spark, sf_dir))


@query
def filter_not_null(spark, sf_dir):
    return (_dirty(spark, sf_dir).filter(F.col("user_id").isNotNull() & F.col("activity_id").isNotNull())
            .select("event_id", "user_id", "activity_id"))


@query
def filter_conjunction(spark, sf_dir):
    chosen = (F.col("activity_id").eqNullSafe(F.lit(20683)) & (F.col("heart_rate") == 100)
              & (F.to_date("event_timestamp") >= F.lit("2024-01-10").cast("date")))
    return _hr(spark, sf_dir).filter(chosen).select("event_id", "user_id", "activity_id", "heart_rate")


@query
def json_flatten(spark, sf_dir):
    return _dirty(spark, sf_dir).select("event_id", "activity_id", "latitude", "longitude")


@query
def parse_yyyymmdd(spark, sf_dir):
    """Birth dates, of which some are made impossible."""
    dob = F.when(F.col("height") >= 190, F.col("dob") + 1300).otherwise(F.col("dob"))
    parsed = clean.parse_yyyymmdd(dob)
    return testdata.raw_users(spark, sf_dir).select(
        "userid", dob.alias("dob"), parsed.alias("date_of_birth"), parsed.isNull().alias("rejected"))


@query
def epoch_to_timestamp(spark, sf_dir):
    at = clean.epoch_to_timestamp(F.col("timestamp"))
    return _naive(testdata.raw_heart_rate(spark, sf_dir).select(
        "event_id", "timestamp", at.alias("event_timestamp"), F.date_format(at, "HH:mm:ss").alias("event_time")))


@query
def epoch_out_of_range(spark, sf_dir):
    """Epochs in seconds, in milliseconds and beyond any calendar: NULL instead of an error."""
    seconds = F.col("timestamp")
    wrong = (F.when(F.col("heart_rate") > 150, seconds * 1000)
             .when(F.col("heart_rate") > 100, seconds * 1_000_000_000).otherwise(seconds))
    return _naive(testdata.raw_heart_rate(spark, sf_dir).select("event_id", wrong.alias("timestamp")).select(
        "event_id", "timestamp", clean.epoch_to_timestamp(F.col("timestamp")).alias("event_timestamp")))


@query
def dedup_conflicts(spark, sf_dir):
    """Copies that differ: a whole record that was sent stays, the one of least values, NULL last."""
    readings = _hr(spark, sf_dir)
    other = readings.withColumns({"heart_rate": F.col("heart_rate") + 1, "latitude": F.lit(None).cast("double")})
    third = readings.withColumns({"heart_rate": F.lit(None).cast("bigint"), "longitude": F.lit(-180.0)})
    return _naive(keys.dedup_events(readings.unionByName(other).unionByName(third)))


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _hr(spark, sf_dir)
    again = readings.filter(F.col("heart_rate") >= 100)
    return readings.unionByName(again).unionByName(again)


@query
def dedup_events(spark, sf_dir):
    return _naive(keys.dedup_events(_redelivered(spark, sf_dir)))


@query
def dedup_latest(spark, sf_dir):
    snapshots = testdata.user_snapshots(spark, sf_dir).select("user_id", "last_update", "version", "address")
    return _naive(keys.dedup_latest(snapshots, "user_id", "last_update"))


# Keys and history -------------------------------------------------------------

@query
def surrogate_key(spark, sf_dir):
    return _users(spark, sf_dir).select(
        "user_id", "start_date", keys.surrogate_key("user_id", "start_date", algorithm="md5").alias("user_sk"))


@query
def scd2_history(spark, sf_dir):
    history = keys.scd2_history(testdata.user_snapshots(spark, sf_dir), "user_id",
                                ["last_update", "version"], "update_day", ["address", "blood_type"])
    return history.withColumn(
        "user_sk", keys.surrogate_key("user_id", "start_date", algorithm="md5"))


@query
def scd2_merge(spark, sf_dir):
    """A history of the orders before 1996, brought up to date with the later ones."""
    snapshots = testdata.user_snapshots(spark, sf_dir)
    how = ("user_id", ["last_update", "version"], "update_day", ["address", "blood_type"])
    history = keys.scd2_history(snapshots.filter(F.col("update_day") < F.lit("1996-01-01").cast("date")), *how)
    later = snapshots.filter(F.col("update_day") >= F.lit("1996-01-01").cast("date"))
    return keys.scd2_merge(history, later, *how)


@query
def dim_users_history(spark, sf_dir):
    """The versions of the users from three files, later ones with older updates in them."""
    lake = _lake(spark, "history")
    lake.write(testdata.raw_activities(spark, sf_dir), "bronze", "raw_activities")
    files = testdata.user_files(spark, sf_dir)
    for delivery in range(3):
        lake.write(files.filter(F.col("delivery") == delivery).drop("delivery"), "bronze", "raw_users")
        refresh.build_dimensions(lake)
    return lake.read("silver", "dim_users_history").select(
        "user_id", "first_name", "address", "start_date", "end_date",
        keys.surrogate_key("user_id", "start_date", algorithm="md5").alias("user_sk"))


@query
def fact_by_version(spark, sf_dir):
    """Readings with the record of their user and activity that was valid on their day, after an increment
    whose user file also holds older updates."""
    lake = _lake(spark, "versions")
    lake.write(testdata.raw_activities(spark, sf_dir), "bronze", "raw_activities")
    lake.write(testdata.raw_heart_rate(spark, sf_dir), "bronze", "heartrate_stream")
    files = testdata.user_files(spark, sf_dir)
    lake.write(files.filter("delivery > 0").drop("delivery"), "bronze", "raw_users")
    refresh.full_refresh(lake)
    lake.write(files.filter("delivery = 0").drop("delivery"), "bronze", "raw_users")
    refresh.incremental_refresh(lake, arrived_since=datetime.date.today() + datetime.timedelta(days=2))
    fact = lake.read("gold", "fct_heart_rate", extra=("user_sk", "activity_sk"))
    users = lake.read("gold", "dim_users_history").select("user_sk", "address", F.col("start_date").alias("valid_from"))
    activities = lake.read("gold", "dim_activities_history").select("activity_sk", "activity_name")
    return fact.join(users, "user_sk", "left").join(F.broadcast(activities), "activity_sk", "left").select(
        "user_key", "event_date", "event_time", "heart_rate", "previous_heart_rate", "address", "valid_from", "activity_name")


# Joins ------------------------------------------------------------------------

def _reading_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select("event_id", "user_key", "heart_rate", *more)


def _with_strangers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings, those of odd heart rates by users and of activities that no dimension has."""
    odd = F.col("heart_rate") % 2 == 1
    return gold.base(_hr(spark, sf_dir)).withColumns({
        "user_key": F.when(odd, -F.col("user_key")).otherwise(F.col("user_key")),
        "activity_id": F.when(odd, -F.col("activity_id")).otherwise(F.col("activity_id"))})


@query
def join_users(spark, sf_dir):
    rows = _with_strangers(spark, sf_dir)
    joined = gold.join_users(rows, _users(spark, sf_dir), ["gender", "address_country"], hot_keys(rows, "user_key"))
    return _reading_columns(joined, "gender", "address_country")


@query
def join_users_hot_split(spark, sf_dir):
    """The same with the busier users treated as hot."""
    rows = _with_strangers(spark, sf_dir)
    hot = hot_keys(rows, "user_key", min_rows=66, share=0.0001)
    return _reading_columns(gold.join_users(rows, _users(spark, sf_dir), ["gender", "address_country"], hot),
                            "gender", "address_country")


@query
def join_activities(spark, sf_dir):
    return _reading_columns(gold.join_activities(_with_strangers(spark, sf_dir), _activities(spark, sf_dir)),
                            "activity_name")


@query
def join_date(spark, sf_dir):
    rows = gold.base(_hr(spark, sf_dir))
    dates = dims.dim_date_covering(_hr(spark, sf_dir), "event_timestamp")
    return _reading_columns(gold.join_date(rows, dates, ["day_name", "is_weekend"]),
                            "event_date", "day_name", "is_weekend")


@query
def join_time(spark, sf_dir):
    rows = gold.base(_hr(spark, sf_dir))
    return _reading_columns(gold.join_time(rows, dims.dim_time(spark), ["hour", "time_category"]),
                            "event_time", "hour", "time_category")


@query
def star_join(spark, sf_dir):
    hr = _hr(spark, sf_dir)
    rows = gold.base(hr)
    joined = gold.star(rows, _users(spark, sf_dir), _activities(spark, sf_dir),
                       dims.dim_date_covering(hr, "event_timestamp"), dims.dim_time(spark),
                       hot_keys(rows, "user_key"))
    return _reading_columns(joined, "event_date", "event_time", "day_name", "is_weekend",
                            "time_category", "activity_name", "gender", "race", "address_country")


# Aggregates, sort, questions --------------------------------------------------

@query
def daily_hr_stats(spark, sf_dir):
    return analytics.daily_hr_stats(_hr(spark, sf_dir))


@query
def first_event_date(spark, sf_dir):
    return analytics.first_event_date(_hr(spark, sf_dir))


@query
def first_event_per_user(spark, sf_dir):
    return _naive(analytics.first_event_per_user(_hr(spark, sf_dir)))


@query
def user_timeline(spark, sf_dir):
    return _naive(analytics.user_timeline(
        _hr(spark, sf_dir).select("user_id", "event_timestamp", "event_id", "heart_rate")))


@query
def hr_by_activity_demographic(spark, sf_dir):
    return analytics.by_activity_and_demographic(
        _hr(spark, sf_dir), _users(spark, sf_dir), _activities(spark, sf_dir))


@query
def hr_seasonal(spark, sf_dir):
    return analytics.seasonal(_hr(spark, sf_dir), "week")


@query
def activity_likelihood(spark, sf_dir):
    return analytics.activity_likelihood(
        _hr(spark, sf_dir), _users(spark, sf_dir), _activities(spark, sf_dir))


@query
def prior_period_compare(spark, sf_dir):
    return analytics.prior_period(analytics.daily_hr_stats(_hr(spark, sf_dir)), days=1)


# Windows and the fact ---------------------------------------------------------

def _window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.base(_hr(spark, sf_dir)).select(
        "event_id", "user_key", "heart_rate", "event_date", "activity_id", "event_timestamp")


def _lag(rows: DataFrame, hot) -> DataFrame:
    return ordered.with_previous(
        rows.select("event_id", "user_key", "heart_rate", "event_timestamp"),
        "user_key", "event_timestamp", "event_id", "heart_rate", "previous_heart_rate", hot
    ).drop("event_timestamp")


@query
def win_lag(spark, sf_dir):
    return _lag(_window_rows(spark, sf_dir), None)


@query
def win_lag_hot_split(spark, sf_dir):
    """The same with the busier users treated as hot."""
    rows = _window_rows(spark, sf_dir)
    return _lag(rows, hot_keys(rows, "user_key", min_rows=66, share=0.0001))


def _stat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = _window_rows(spark, sf_dir).drop("event_timestamp")
    return ordered.with_group_stats(rows, gold.DAILY_GROUP, {name: gold.daily_stats()[name]})


@query
def win_max(spark, sf_dir):
    return _stat(spark, sf_dir, "max_heart_rate")


@query
def win_min(spark, sf_dir):
    return _stat(spark, sf_dir, "min_heart_rate")


@query
def win_avg(spark, sf_dir):
    return _stat(spark, sf_dir, "avg_heart_rate")


@query
def fct_heart_rate(spark, sf_dir):
    return gold.fct_heart_rate(_hr(spark, sf_dir))


@query
def fct_heart_rate_hot_split(spark, sf_dir):
    """The fact with the busier users treated as hot."""
    hr = _hr(spark, sf_dir)
    return gold.fct_heart_rate(hr, hot_keys(hr, "user_id", min_rows=66, share=0.0001))


@query
def fct_heart_rate_by_day(spark, sf_dir):
    """The fact as the refresh computes it, laid out for a write by day."""
    hr = _hr(spark, sf_dir)
    return gold.fact_by_day(hr, silver.last_readings(hr))


# Dimensions -------------------------------------------------------------------

@query
def dim_date(spark, sf_dir):
    """The calendar the orders span, with the orders of each day."""
    orders = testdata.table(spark, sf_dir, "orders")
    days = dims.dim_date_covering(orders, "o_orderdate")
    per_day = (orders.groupBy(F.to_date("o_orderdate").alias("date_day"))
               .agg(F.count(F.lit(1)).alias("orders")))
    return days.join(per_day, "date_day", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def calendar_month_ends(spark, sf_dir):
    """The calendar of the readings with month ends, and the readings of each day."""
    last = silver.last_readings(_hr(spark, sf_dir))
    per_day = (_hr(spark, sf_dir).groupBy(F.to_date("event_timestamp").alias("date_day"))
               .agg(F.count(F.lit(1)).alias("readings")))
    days = dims.calendar_of(last, "event_timestamp").select("date_day", "month_end_date", "year_end_date")
    return days.join(per_day, "date_day", "left").withColumn("readings", F.coalesce("readings", F.lit(0)))


@query
def dim_time(spark, sf_dir):
    """The minutes of the day, with the readings of each."""
    per_minute = (_hr(spark, sf_dir).groupBy(calendar.minute_of_day(F.col("event_timestamp")).alias("time_of_day"))
                  .agg(F.count(F.lit(1)).alias("readings")))
    return (dims.dim_time(spark).join(per_minute, "time_of_day", "left")
            .withColumn("readings", F.coalesce("readings", F.lit(0))))


@query
def time_category(spark, sf_dir):
    """Readings per category of the time of day."""
    return (_hr(spark, sf_dir).groupBy(calendar.time_category(F.hour("event_timestamp")).alias("time_category"))
            .agg(F.count(F.lit(1)).alias("readings")))


@query
def weekday_flags(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return testdata.table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("date"), calendar.day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), calendar.is_weekend(day).alias("is_weekend"))


# Quality ----------------------------------------------------------------------

@query
def dq_not_null(spark, sf_dir):
    return quality.report(_dirty(spark, sf_dir), "readings",
                          quality.not_null("user_id", "heart_rate", "activity_id", "event_timestamp"))


@query
def dq_castable(spark, sf_dir):
    texts = testdata.raw_users(spark, sf_dir).select(
        F.when(F.col("height") >= 190, "not a date").otherwise(F.col("last_update")).alias("last_update"),
        F.col("dob").cast("string").alias("dob"), F.col("fname").alias("fname"))
    return quality.report(texts, "users", [
        quality.castable("last_update", "date"), quality.castable("dob", "bigint"),
        quality.castable("fname", "timestamp")])


@query
def dq_all_null(spark, sf_dir):
    users = _users(spark, sf_dir).withColumn(
        "closed", F.when(F.col("height") >= 190, F.col("start_date")))
    return quality.report(users, "users", [quality.all_null("end_date"), quality.all_null("closed")])


@query
def dq_range(spark, sf_dir):
    return quality.report(_dirty(spark, sf_dir), "readings", [
        quality.in_range("latitude", -90, 90), quality.in_range("longitude", -180, 180)])


@query
def dq_accepted_values(spark, sf_dir):
    return quality.report(_users(spark, sf_dir), "users", [
        quality.accepted_values("race", testdata.RACES),
        quality.accepted_values("blood_type", ["A+", "B+", "AB+", "O+"]),
        quality.accepted_values("gender", ["M", "F"])])


@query
def dq_coverage(spark, sf_dir):
    rows = _hr(spark, sf_dir).select(calendar.time_category(F.hour("event_timestamp")).alias("time_category"))
    return quality.coverage(rows, "time_category", [*calendar.CATEGORY_NAMES, "No Such Category"])


def _tampered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with readings above 200 altered after their statistics were taken."""
    return gold.fct_heart_rate(_hr(spark, sf_dir)).withColumn(
        "max_heart_rate", F.when(F.col("heart_rate") > 200, F.col("max_heart_rate") + 1)
        .otherwise(F.col("max_heart_rate")))


@query
def reconcile_window_vs_group(spark, sf_dir):
    return quality.reconcile_groups(_tampered_fact(spark, sf_dir))


@query
def reconcile_detail_rows(spark, sf_dir):
    """Readings whose statistics differ from their group's."""
    return quality.mismatched_rows(_tampered_fact(spark, sf_dir))


@query
def dq_lag_continuity(spark, sf_dir):
    """Readings whose stored previous value is not the one before them."""
    hr = _hr(spark, sf_dir)
    hot = hot_keys(hr, "user_id")
    rows = gold.fact_rows(hr, hot).withColumn(
        "previous_heart_rate", F.when(F.col("heart_rate") > 200, F.lit(0)).otherwise(F.col("previous_heart_rate")))
    return quality.broken_previous(rows, hot).select("event_id", "user_key", "previous_heart_rate", "expected")


@query
def dq_chain_continuity(spark, sf_dir):
    """The user's days on which stored previous values do not continue, told without sorting readings."""
    hr = _hr(spark, sf_dir)
    fact = gold.fct_heart_rate(hr).withColumn("previous_heart_rate", F.when(
        F.col("heart_rate") > 200, F.lit(0)).otherwise(F.col("previous_heart_rate")))
    return quality.broken_chains(fact, gold.user_days(silver.last_readings(hr)))


@query
def dq_first_row_null(spark, sf_dir):
    """A fact in which first readings above 120 have a previous one and later ones above 200 lack it."""
    was = F.col("previous_heart_rate")
    rate = F.col("heart_rate")
    fact = gold.fct_heart_rate(_hr(spark, sf_dir)).withColumn("previous_heart_rate", F.when(
        was.isNull() & (rate > 120), F.lit(0)).when(was.isNotNull() & (rate <= 200), was).when(
        was.isNull(), was))
    return quality.first_row_null(fact)


@query
def hr_band_check(spark, sf_dir):
    rows = gold.join_activities(gold.base(_hr(spark, sf_dir)), _activities(spark, sf_dir))
    return _reading_columns(rows.select(
        "*", bands.band(F.col("activity_name")).alias("band"),
        bands.in_band(F.col("heart_rate"), F.col("activity_name")).alias("plausible")),
        "activity_name", "band", "plausible")


@query
def dq_quarantine(spark, sf_dir):
    path = shared_dir(spark, "quarantine")
    rules = [*quality.not_null("user_id", "activity_id"), quality.in_range("latitude", -90, 90),
             quality.in_range("longitude", -180, 180)]
    quality.quarantine(_dirty(spark, sf_dir), rules, path)
    return spark.read.parquet(path).select(
        "event_id", F.col("quarantined").cast("boolean").alias("quarantined"),
        F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query
def rejected_readings(spark, sf_dir):
    """Readings set aside by a merge of dirty ones; the same load a second time changes nothing."""
    lake = _lake(spark, "rejected")
    dirty = _dirty(spark, sf_dir).select(*schemas.HEART_RATE_CLEANED.names)
    for _ in range(2):
        refresh.merge_readings(lake, dirty, load="first")
    return lake.read("silver", "heart_rate_rejected").select(
        "event_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


# Streaming --------------------------------------------------------------------

def _in_two_runs(spark: SparkSession, sf_dir: str, root: str,
                 writer: Callable[[DataFrame], DataStreamWriter], copies: bool = False) -> int:
    """Run a streaming job on the first delivery and, from its checkpoint, on
    the second, optionally with the first delivered once more. Returns the last
    batch id."""
    done = None
    for second in (False, True):
        _deliver(spark, sf_dir, f"{root}/in", second)
        if second and copies:
            _deliver(spark, sf_dir, f"{root}/in", False)
        events = raw.stream_jsonl(spark, f"{root}/in", with_id=True)
        done = jobs.drain(writer(events), f"{root}/checkpoint")
    return done.lastProgress["batchId"]


@query
def stream_flatten(spark, sf_dir):
    root = shared_dir(spark, "flatten")
    _in_two_runs(spark, sf_dir, root, lambda events: jobs.to_parquet(jobs.flatten(events), f"{root}/out"))
    return _naive(spark.read.parquet(f"{root}/out"))


@query
def stream_lake_sink(spark, sf_dir):
    root = shared_dir(spark, "lakesink")
    _in_two_runs(spark, sf_dir, root, lambda events: jobs.to_lake(events, f"{root}/out"))
    return spark.read.schema(LANDED).json(f"{root}/out").drop("load")


@query
def stream_dedup(spark, sf_dir):
    root = shared_dir(spark, "dedup")

    lake = Lake(spark, f"{root}/lake")
    _in_two_runs(spark, sf_dir, root, lambda events: jobs.dedup(jobs.flatten(events), lake), copies=True)
    return _naive(lake.read("silver", "heart_rate_cleaned"))


@query
def stream_compacted(spark, sf_dir):
    """The same after the deltas of the streams have been taken into their days."""
    root = shared_dir(spark, "compacted")
    lake = Lake(spark, f"{root}/lake")
    _in_two_runs(spark, sf_dir, root, lambda events: jobs.dedup(jobs.flatten(events), lake), copies=True)
    refresh.compact(lake)
    return _naive(lake.read("silver", "heart_rate_cleaned"))


@query
def stream_daily_stats(spark, sf_dir):
    """Every day, the open one too; copies delivered again count once."""
    root = shared_dir(spark, "daily")
    lake = Lake(spark, f"{root}/lake")
    _in_two_runs(spark, sf_dir, root, lambda events: jobs.daily_stats(
        jobs.flatten(events), lake, f"{root}/out"), copies=True)
    return jobs.read_daily_stats(spark, f"{root}/out")


@query
def stream_late_reconciled(spark, sf_dir):
    """The second delivery first, so that the first one is a month late: nothing is lost."""
    root = shared_dir(spark, "late")
    job = jobs.PreviousReading(spark, f"{root}/job", delay=3600)
    done = None
    for second in (True, False):
        _deliver(spark, sf_dir, f"{root}/in", second)
        events = raw.stream_jsonl(spark, f"{root}/in", with_id=True)
        done = jobs.drain(job.writer(jobs.flatten(events)), f"{root}/checkpoint")
    job.finish(done.lastProgress["batchId"])
    return _naive(job.reconciled())


@query
def stream_malformed_kept(spark, sf_dir):
    """Good records in the lake by event hour, the text of broken ones beside it."""
    root = shared_dir(spark, "malformed")
    events = testdata.raw_heart_rate(spark, sf_dir)
    lines = raw.encode_events(events).withColumn("rate", F.get_json_object("value", "$.heart_rate").cast("bigint"))
    broken = F.concat(F.lit('{"user_id": 7, broken '), F.col("rate").cast("string"))
    lines.select(F.when(F.col("rate") > 180, broken).otherwise(F.col("value")).alias("value")).write.text(f"{root}/in")
    jobs.drain(jobs.to_lake(raw.stream_jsonl(spark, f"{root}/in", with_id=True), f"{root}/lake"), f"{root}/checkpoint")
    good = spark.read.schema(LANDED).json(f"{root}/lake").select(
        F.lit("good").alias("status"), "event_id", "heart_rate", F.lit("").alias("record"))
    bad = spark.read.text(f"{root}/lake-malformed").select(
        F.lit("malformed").alias("status"), F.lit(None).cast("bigint").alias("event_id"),
        F.lit(None).cast("bigint").alias("heart_rate"), F.col("value").alias("record"))
    return good.unionByName(bad)


def _streamed_previous(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    job = jobs.PreviousReading(spark, f"{root}/job", delay=3600)
    job.finish(_in_two_runs(spark, sf_dir, root, lambda events: job.writer(jobs.flatten(events))))
    return job.result()


@query
def stream_previous_hr(spark, sf_dir):
    return _naive(_streamed_previous(spark, sf_dir, shared_dir(spark, "previous")))


@query
def replay_equals_stream(spark, sf_dir):
    """Streamed previous values against the batch recomputation from the same files."""
    root = shared_dir(spark, "replay")
    streamed = _streamed_previous(spark, sf_dir, root)
    good, _ = raw.split_corrupt(raw.read_jsonl(spark, f"{root}/in", with_id=True))
    batch = ordered.with_previous(
        silver.heart_rate(good).select(*jobs.PreviousReading.COLUMNS), "user_id", "event_timestamp",
        "event_id", "heart_rate", "previous_heart_rate")
    return jobs.differing_rows(streamed, batch)


# Whole refresh ----------------------------------------------------------------

def _bronze(spark: SparkSession, sf_dir: str, label: str, before: str | None = None) -> Lake:
    lake = _lake(spark, label)
    lake.write(testdata.raw_users(spark, sf_dir), "bronze", "raw_users")
    lake.write(testdata.raw_activities(spark, sf_dir), "bronze", "raw_activities")
    events = testdata.raw_heart_rate(spark, sf_dir)
    if before:
        events = events.filter(F.timestamp_seconds("timestamp") < F.lit(before).cast("timestamp"))
    lake.write(events, "bronze", "heartrate_stream")
    return lake


@query
def medallion_refresh(spark, sf_dir):
    return refresh.full_refresh(_bronze(spark, sf_dir, "refresh"))


@query
def incremental_refresh(spark, sf_dir):
    """A refresh without the second delivery, some late readings and some users, then the
    increment of what arrived since."""
    lake = _lake(spark, "increment")
    events, users = testdata.raw_heart_rate(spark, sf_dir), testdata.raw_users(spark, sf_dir)
    first = ((F.timestamp_seconds("timestamp") < F.lit(SECOND_DELIVERY).cast("timestamp"))
             & (F.col("event_id") % 7 != 0))
    lake.write(users.filter(F.col("userid") % 5 != 0), "bronze", "raw_users")
    lake.write(testdata.raw_activities(spark, sf_dir), "bronze", "raw_activities")
    lake.write(events.filter(first), "bronze", "heartrate_stream")
    refresh.full_refresh(lake)
    lake.write(users, "bronze", "raw_users")
    lake.write(events.filter(~first), "bronze", "heartrate_stream", mode="append")
    refresh.incremental_refresh(lake, arrived_since=datetime.date.today() - datetime.timedelta(days=1))
    known = lake.read("gold", "dim_users").select(F.col("user_id").alias("user_key"), "gender")
    return lake.read("gold", "fct_heart_rate").join(known, "user_key", "left")


@query
def increment_a_year_late(spark, sf_dir):
    """A refresh, then an increment of readings that are dated a year before all others."""
    lake = _lake(spark, "late-year")
    events = testdata.raw_heart_rate(spark, sf_dir)
    late = F.col("heart_rate") > 203
    lake.write(testdata.raw_users(spark, sf_dir), "bronze", "raw_users")
    lake.write(testdata.raw_activities(spark, sf_dir), "bronze", "raw_activities")
    lake.write(events.filter(~late), "bronze", "heartrate_stream")
    refresh.full_refresh(lake)
    old = events.filter(late).withColumn("timestamp", F.col("timestamp") - 366 * 86400)
    lake.write(old, "bronze", "heartrate_stream")
    refresh.incremental_refresh(lake)
    return lake.read("gold", "fct_heart_rate")
