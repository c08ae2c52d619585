import datetime

from pyspark.sql import functions as F

from frames import meta, raw_activities, raw_events, raw_users
from pulselake import schemas
from pulselake.functions import clean
from pulselake.plans import silver


def test_users_are_renamed_cast_and_left_open(spark):
    df = silver.users(raw_users(spark, [{}, {"userid": None}]))
    schemas.check_contract(df, schemas.DIM_USERS)
    row = df.collect()
    assert len(row) == 1
    row = row[0]
    assert (row.user_id, row.first_name, row.gender) == (10001, "Ann", "F")
    assert row.date_of_birth == datetime.date(1984, 2, 29)
    assert (row.origin_country, row.address_country) == ("United States", "United Kingdom")
    assert row.start_date == datetime.date(2024, 10, 28)
    assert row.end_date is None


def test_bad_birth_dates_become_null_and_are_counted(spark):
    raw = raw_users(spark, [{"userid": i, "dob": dob} for i, dob in
                            enumerate([19991340, 199901, None, 20230229, 19000101, -9991231])])
    found = {r.user_id: r.date_of_birth for r in silver.users(raw).collect()}
    assert found[4] == datetime.date(1900, 1, 1)
    assert [found[i] for i in (0, 1, 2, 3, 5)] == [None] * 5
    assert sorted(r.userid for r in silver.unparsed_dates(raw).collect()) == [0, 1, 3, 5]


def test_unparseable_update_time_gives_null_start(spark):
    df = silver.users(raw_users(spark, [{"last_update": "soon"}]))
    assert df.first().start_date is None


def test_activities(spark):
    df = silver.activities(raw_activities(spark, [(20683, "Run"), (None, "Ghost")]))
    schemas.check_contract(df, schemas.DIM_ACTIVITIES)
    assert [(r.activity_id, r.activity_name, r.end_date) for r in df.collect()] == [(20683, "Run", None)]


def test_latest_record_of_a_user_wins(spark):
    raw = raw_users(spark, [
        {"weight": 60, "last_update": "2024-01-01T00:00:00Z"},
        {"weight": 62, "last_update": "2024-03-01T00:00:00Z"},
        {"weight": 61, "last_update": "2024-02-01T00:00:00Z"},
        {"weight": 99, "last_update": None}])
    assert [r.weight for r in silver.latest_users(raw).collect()] == [62]


def test_heart_rate_is_flattened(spark):
    df = silver.heart_rate(raw_events(spark, [(1, 10001, 128, "2024-03-31T23:59:32", meta())]))
    schemas.check_contract(df, schemas.HEART_RATE_CLEANED)
    row = df.withColumn("t", F.col("event_timestamp").cast("string")).first()
    assert row.t == "2024-03-31 23:59:32"
    assert (row.activity_id, row.latitude, row.longitude) == (20683, 1.5, -2.5)


def test_damaged_documents_keep_their_good_fields(spark):
    rows = [
        (1, 1, 80, "2024-01-01T00:00:00", "{broken"),
        (2, 1, 80, "2024-01-01T00:00:01", None),
        (3, 1, 80, "2024-01-01T00:00:02", '{"activity_id": 5, "location": {"latitude": 9.5}}'),
        (4, 1, 80, "2024-01-01T00:00:03", '{"activity_id": "x", "location": {"latitude": 1.0, "longitude": 2.0}}'),
        (5, None, 80, "2024-01-01T00:00:04", meta()),
    ]
    found = {r.event_id: (r.activity_id, r.latitude, r.longitude)
             for r in silver.heart_rate(raw_events(spark, rows)).collect()}
    assert found == {1: (None, None, None), 2: (None, None, None), 3: (5, 9.5, None), 4: (None, 1.0, 2.0)}


def test_event_id_is_derived_when_the_source_has_none(spark):
    raw = raw_events(spark, [
        (0, 1, 80, "2024-01-01T00:00:00", meta()), (0, 1, 80, "2024-01-01T00:00:00", meta()),
        (0, 1, 81, "2024-01-01T00:00:00", meta())]).drop("event_id")
    assert silver.heart_rate(raw).select("event_id").distinct().count() == 2
    assert silver.distinct_heart_rate(raw).count() == 2


def test_as_date_accepts_instants_and_dates(spark):
    df = spark.createDataFrame([("2024-10-28T12:08:02Z",), ("2024-10-28",), ("28/10/2024",)], "s string")
    got = [r[0] for r in df.select(clean.as_date(F.col("s"))).collect()]
    assert got == [datetime.date(2024, 10, 28)] * 2 + [None]


def test_a_null_event_id_is_derived_too(spark):
    raw = raw_events(spark, [(None, 1, 80, "2024-01-01T00:00:00", meta()), (7, 1, 80, "2024-01-01T00:00:00", meta())])
    ids = sorted(r.event_id for r in silver.heart_rate(raw).collect())
    assert 7 in ids and None not in ids and len(set(ids)) == 2


def test_last_reading_of_each_day(spark):
    hr = silver.heart_rate(raw_events(spark, [
        (1, 1, 60, "2024-01-01T00:00:00", meta()), (3, 1, 61, "2024-01-01T09:00:00", meta()),
        (2, 1, 62, "2024-01-01T09:00:00", meta()), (4, 1, 63, "2024-01-02T00:00:00", meta())]))
    df = silver.last_readings(hr)
    schemas.check_contract(df, schemas.LAST_READINGS)
    assert sorted(r.event_id for r in df.collect()) == [3, 4]
