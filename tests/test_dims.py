import datetime

from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.functions.calendar import CATEGORY_NAMES, minute_of_day, season, time_category
from pulselake.plans import dims

D = datetime.date


def test_default_calendar(spark):
    df = dims.dim_date(spark)
    schemas.check_contract(df, schemas.DIM_DATE)
    rows = {r.date_day: r for r in df.collect()}
    assert len(rows) == 1096
    assert (min(rows), max(rows)) == (D(2024, 1, 1), D(2026, 12, 31))
    leap = rows[D(2024, 2, 29)]
    assert (leap.prior_date_day, leap.next_date_day) == (D(2024, 2, 28), D(2024, 3, 1))
    assert leap.prior_year_date_day == D(2023, 3, 1)
    assert leap.prior_year_over_year_date_day.weekday() == D(2024, 2, 29).weekday()
    assert (leap.year_start_date, leap.year_end_date) == (D(2024, 1, 1), D(2024, 12, 31))
    assert (leap.day, leap.day_of_week, leap.day_name, leap.is_weekend) == (29, 4, "Thursday", False)
    last = rows[D(2024, 12, 31)]
    assert (last.year_start_date, last.year_end_date) == (D(2024, 1, 1), D(2024, 12, 31))
    saturday, sunday = rows[D(2024, 6, 1)], rows[D(2024, 6, 2)]
    assert (saturday.day_of_week, saturday.is_weekend) == (6, True)
    assert (sunday.day_of_week, sunday.is_weekend) == (7, True)


def test_calendar_covering_data(spark):
    df = spark.createDataFrame([(D(2023, 5, 1),), (D(2024, 2, 2),), (None,)], "d date")
    rows = dims.dim_date_covering(df, "d").agg(F.min("date"), F.max("date"), F.count("date")).first()
    assert tuple(rows) == (D(2023, 1, 1), D(2024, 12, 31), 365 + 366)


def test_time_of_day(spark):
    df = dims.dim_time(spark)
    schemas.check_contract(df, schemas.DIM_TIME)
    rows = {r.time_of_day: r for r in df.collect()}
    assert len(rows) == 1440
    assert {r.second for r in rows.values()} == {0}
    assert {r.time_category for r in rows.values()} == set(CATEGORY_NAMES)
    at = {t: rows[t].time_category for t in ("00:00:00", "05:59:00", "06:00:00", "11:59:00", "12:00:00",
                                             "17:59:00", "18:00:00", "21:59:00", "22:00:00", "23:59:00")}
    assert list(at.values()) == ["Early Morning"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + \
        ["Evening"] * 2 + ["Night"] * 2


def test_every_second_finds_its_minute(spark):
    df = spark.createDataFrame([("2024-01-01 05:59:59",), ("2024-01-01 21:59:59",)], "s string")
    ts = F.col("s").cast("timestamp")
    got = df.select(minute_of_day(ts), time_category(F.hour(ts))).collect()
    assert [tuple(r) for r in got] == [("05:59:00", "Early Morning"), ("21:59:00", "Evening")]


def test_seasons(spark):
    df = spark.createDataFrame([(D(2024, m, 1),) for m in range(1, 13)], "d date")
    got = [r[0] for r in df.select(season(F.col("d"))).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
