import datetime
import os

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_events, raw_users
from pulselake.plans import silver
from pulselake.registry import Lake, UnknownTable
from pulselake.schemas import SchemaMismatch, check_contract
from pulselake import schemas


def test_unknown_tables_fail_before_any_read(spark, path):
    lake = Lake(spark, path)
    for call in (lambda: lake.read("silver", "users"), lambda: lake.path("platinum", "dim_users")):
        with pytest.raises(UnknownTable):
            call()


def test_contract_covers_names_and_types(spark):
    df = spark.createDataFrame([(1, "Run")], "activity_id int, activity_name string")
    with pytest.raises(SchemaMismatch, match="activity_id"):
        check_contract(df, schemas.RAW_ACTIVITY)
    users = raw_users(spark, [{}])
    assert check_contract(users.select(*reversed(users.columns)), schemas.RAW_USER).columns == users.columns


def test_a_wrong_frame_is_not_written(spark, path):
    with pytest.raises(SchemaMismatch):
        Lake(spark, path).write(spark.range(3), "silver", "dim_users")
    assert not os.path.exists(path + "/silver")


def hr(spark, *rows):
    return silver.heart_rate(raw_events(spark, [(i, 1, rate, t, meta()) for i, rate, t in rows]))


def test_overwrite_append_and_partition_overwrite(spark, path):
    lake = Lake(spark, path)
    lake.write(hr(spark, (1, 60, "2024-01-01T00:00:00"), (2, 61, "2024-01-02T00:00:00")),
               "silver", "heart_rate_cleaned")
    lake.write(hr(spark, (3, 62, "2024-01-02T01:00:00")), "silver", "heart_rate_cleaned", only_partitions=True)
    ids = lambda: sorted(r.event_id for r in lake.read("silver", "heart_rate_cleaned").collect())
    assert ids() == [1, 3]
    lake.write(hr(spark, (4, 63, "2024-01-02T02:00:00")), "silver", "heart_rate_cleaned", mode="append")
    assert ids() == [1, 3, 4]
    lake.write(hr(spark, (5, 64, "2024-01-09T00:00:00")), "silver", "heart_rate_cleaned")
    assert ids() == [5]
    assert lake.read("silver", "heart_rate_cleaned").columns == schemas.HEART_RATE_CLEANED.names


def test_days_are_pruned(spark, path):
    lake = Lake(spark, path)
    lake.write(hr(spark, (1, 60, "2024-01-01T00:00:00"), (2, 61, "2024-01-02T00:00:00")),
               "silver", "heart_rate_cleaned")
    df = lake.read("silver", "heart_rate_cleaned", where="event_day >= date'2024-01-02'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert [r.event_id for r in df.collect()] == [2]


def test_another_format_is_an_option(spark, path):
    lake = Lake(spark, path, fmt="orc", options={"compression": "zlib"})
    lake.write(raw_users(spark, [{}]), "bronze", "raw_users")
    assert lake.read("bronze", "raw_users").first().userid == 10001
    assert spark.read.orc(path + "/bronze/raw_user").count() == 1


def test_event_day_is_the_utc_day(spark, path):
    lake = Lake(spark, path)
    lake.write(hr(spark, (1, 60, "2024-01-01T23:59:59")), "silver", "heart_rate_cleaned")
    assert os.listdir(path + "/silver/heart_rate_cleaned")
    assert os.path.isdir(path + "/silver/heart_rate_cleaned/event_day=2024-01-01")
    assert lake.read("silver", "heart_rate_cleaned").select(
        F.to_date("event_timestamp")).first()[0] == datetime.date(2024, 1, 1)


def test_another_time_zone_is_refused(spark, path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="Asia/Tokyo"):
            Lake(spark, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
