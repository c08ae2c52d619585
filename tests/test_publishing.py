"""Refreshes that are checked before they are published, and what an increment touches."""

import datetime
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_activities, raw_events, raw_users
from pulselake.operators import quality as q
from pulselake.operators.quality import QualityError
from pulselake.operators.skew import Hot
from pulselake.plans import gold, refresh, silver
from pulselake.registry import Lake
from pulselake.streaming.jobs import differing_rows
from pulselake.versions import Conflict

D = datetime.date
USERS = [{"userid": u, "last_update": "2024-01-01T00:00:00Z"} for u in range(10001, 10021)]
YESTERDAY = datetime.date.today() - datetime.timedelta(days=1)


def readings(spark, days, start=0, users=4):
    return raw_events(spark, [(start + 1000 * k + i, 10001 + i % users, 50 + (k * 37 + i * 11) % 140, f"{d}T{i:02d}:00:{i:02d}", meta())
                              for k, d in enumerate(days) for i in range(12)])


def bronze(spark, path, raw, users=USERS):
    lake = Lake(spark, path)
    lake.write(raw_users(spark, users), "bronze", "raw_users")
    lake.write(raw_activities(spark), "bronze", "raw_activities")
    lake.write(raw, "bronze", "heartrate_stream")
    return lake


def rows(df):
    return sorted(map(str, df.collect()))


def files(path):
    """Data files that a reader of the published state can see, by content."""
    out = {}
    for top in ("silver", "gold", "_versions"):
        for at, _, names in os.walk(f"{path}/{top}"):
            for n in names:
                if not n.startswith((".", "_")) and "manifest" not in n:
                    out[f"{at}/{n}"] = hashlib.md5(open(f"{at}/{n}", "rb").read()).hexdigest()
    return out


def named_runs(lake, table):
    return lake._manifest().current()[1][table]


def test_a_failed_check_over_existing_tables_changes_nothing(spark, path, monkeypatch):
    lake = bronze(spark, path, readings(spark, ["2024-01-01", "2024-01-02"]))
    refresh.full_refresh(lake)
    before, state = files(path), lake._manifest().current()
    lake.write(readings(spark, ["2024-01-03"], start=9000), "bronze", "heartrate_stream", mode="append")
    good = gold.fact_by_day
    monkeypatch.setattr(gold, "fact_by_day", lambda *a, **k: good(*a, **k).withColumn(
        "previous_heart_rate", F.when(F.col("heart_rate") > 100, F.lit(7).cast("bigint")).otherwise(F.col("previous_heart_rate"))))
    for run in (lambda: refresh.full_refresh(lake), lambda: refresh.incremental_refresh(lake, arrived_since=YESTERDAY)):
        with pytest.raises(QualityError, match="previous values continue"):
            run()
        assert files(path) == before and lake._manifest().current() == state
    monkeypatch.setattr(gold, "fact_by_day", good)
    refresh.incremental_refresh(lake, arrived_since=YESTERDAY)
    assert lake.read("gold", "fct_heart_rate").count() == 36


def test_readers_see_a_transaction_whole_or_not_at_all(spark, path):
    lake = Lake(spark, path)
    with lake.transaction() as draft:
        draft.write(silver.users(raw_users(spark, USERS[:2])), "silver", "dim_users")
        assert draft.read("silver", "dim_users").count() == 2
        assert lake.read_if_any("silver", "dim_users").count() == 0
    assert lake.read("silver", "dim_users").count() == 2
    with pytest.raises(ZeroDivisionError):
        with lake.transaction() as draft:
            draft.write(silver.users(raw_users(spark, USERS[:5])), "silver", "dim_users")
            1 / 0
    assert lake.read("silver", "dim_users").count() == 2
    lake.write(silver.users(raw_users(spark, USERS[:3])), "silver", "dim_users", mode="append")
    assert lake.read("silver", "dim_users").count() == 5


def test_the_second_of_two_transactions_is_refused(spark, path):
    lake = Lake(spark, path)
    with pytest.raises(Conflict):
        with lake.transaction() as one:
            with lake.transaction() as two:
                for draft in (one, two):
                    draft.write(silver.users(raw_users(spark, USERS[:2])), "silver", "dim_users")
    assert lake.read("silver", "dim_users").count() == 2 and len(os.listdir(path + "/_versions/silver/dim_users")) == 1


def test_old_versions_are_collected(spark, path):
    lake = Lake(spark, path)
    for n in range(1, 6):
        with lake.transaction() as draft:
            draft.write(silver.users(raw_users(spark, USERS[:n])), "silver", "dim_users")
    assert len(os.listdir(path + "/_versions/silver/dim_users")) == 2  # the present and the one before
    assert lake.read("silver", "dim_users").count() == 5


def test_partitions_written_before_and_within_transactions_are_read_together(spark, path):
    lake = Lake(spark, path)
    lake.write(silver.heart_rate(readings(spark, ["2024-01-01", "2024-01-02"])), "silver", "heart_rate_cleaned")
    with lake.transaction() as draft:
        draft.write(silver.heart_rate(readings(spark, ["2024-01-02"], start=5000)).limit(3), "silver", "heart_rate_cleaned",
                    only_partitions=True)
    got = lake.read("silver", "heart_rate_cleaned").groupBy(F.to_date("event_timestamp").alias("d")).count().collect()
    assert {str(r.d): r["count"] for r in got} == {"2024-01-01": 12, "2024-01-02": 3}
    plan = lake.read("silver", "heart_rate_cleaned", "event_day = date'2024-01-02'")
    assert plan.count() == 3 and "PartitionFilters: [isnotnull(event_day" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [Hot(), Hot([10001, 10003], 1)])
def test_a_reading_a_year_late_rewrites_its_day_and_the_users_next_one(spark, path, monkeypatch, hot):
    monkeypatch.setattr(gold, "hot_keys", lambda *a: hot)
    first = readings(spark, ["2023-01-01", "2024-01-01", "2024-02-01", "2024-03-01"])
    lake = bronze(spark, path, first)
    refresh.full_refresh(lake)
    before = named_runs(lake, "gold.fct_heart_rate")
    late = raw_events(spark, [(7777, 10002, 133, "2023-01-20T00:00:00", meta())])
    lake.write(late, "bronze", "heartrate_stream", mode="append")
    load = [r.load for r in lake.read("bronze", "heartrate_stream", extra=("load",)).filter("event_id = 7777").collect()]
    monkeypatch.setattr(lake, "read", lambda layer, key, where=None, extra=(): Lake.read(
        lake, layer, key, f"load = '{load[0]}'" if key == "heartrate_stream" else where, extra))
    assert refresh.incremental_refresh(lake) == D(2023, 1, 20)
    monkeypatch.undo()
    after = named_runs(lake, "gold.fct_heart_rate")
    changed = {leaf for leaf in after if after[leaf] != before.get(leaf)}
    assert changed == {"event_date=2023-01-20", "event_date=2024-01-01"}
    want = gold.fct_heart_rate(silver.heart_rate(first.union(late)), Hot())
    assert tuple(differing_rows(lake.read("gold", "fct_heart_rate"), want).first()) == (49, 49, 0)


def test_the_same_load_twice_sets_the_same_readings_aside(spark, path):
    lake = Lake(spark, path)
    fresh = silver.heart_rate(readings(spark, ["2024-01-01"]).union(
        raw_events(spark, [(1, 10001, None, "2024-01-01T00:00:00", meta()), (2, 10001, 70, "1999-12-31T23:59:59", meta())])))
    for _ in range(2):
        assert refresh.merge_readings(lake, fresh, load="stream-1-0") == D(2024, 1, 1)
        got = {r.event_id: r.failed_rules for r in lake.read("silver", "heart_rate_rejected").collect()}
        assert got == {1: ["not_null(heart_rate)"], 2: ["event_day(2000-01-01,2099-12-31)"]}
        assert lake.read("silver", "heart_rate_cleaned").count() == 12
    refresh.merge_readings(lake, fresh, load="stream-1-1")
    assert lake.read("silver", "heart_rate_rejected").count() == 4


def test_a_user_without_a_birth_date_is_set_aside_and_blocks_nobody(spark, path):
    lake = bronze(spark, path, readings(spark, ["2024-01-01"]), USERS + [{"userid": 1, "dob": None}])
    for _ in range(2):
        assert refresh.full_refresh(lake).count() == 12
        assert lake.read("gold", "dim_users").count() == 20
        got = [(r.user_id, r.failed_rules) for r in lake.read("silver", "dim_users_rejected").collect()]
        assert got == [(1, ["castable(date_of_birth,date)"])]


def test_the_calendar_holds_every_day_of_the_fact(spark, path):
    lake = bronze(spark, path, readings(spark, ["2022-11-05", "2024-01-01"]))
    refresh.full_refresh(lake)
    days = lake.read("gold", "dim_date", extra=("month_end_date",))
    assert days.agg(F.min("date_day"), F.max("date_day")).first() == (D(2022, 1, 1), D(2026, 12, 31))
    ends = {str(r.date_day): str(r.month_end_date) for r in days.filter("date_day in ('2022-11-05', '2024-02-01')").collect()}
    assert ends == {"2022-11-05": "2022-11-30", "2024-02-01": "2024-02-29"}
    with lake.transaction() as draft:
        draft.write(lake.read("silver", "dim_date", "year(date_day) > 2023", extra=("month_end_date",)), "silver", "dim_date")
    with pytest.raises(QualityError, match="days are in the calendar: 1"):
        refresh.check_gold(lake)


def test_chains_are_told_without_order(spark):
    hr = silver.heart_rate(readings(spark, ["2024-01-01", "2024-01-02", "2024-01-09"]))
    days = gold.user_days(silver.last_readings(hr))
    fact = gold.fct_heart_rate(hr, Hot())
    assert q.broken_chains(fact, days).count() == 0
    for change in (F.when((F.col("user_key") == 10001) & (F.col("event_date") == "2024-01-02"), F.col("previous_heart_rate") + 1),
                   F.when(F.col("previous_heart_rate").isNull() & (F.col("user_key") == 10002), F.lit(3))):
        wrong = fact.withColumn("previous_heart_rate", F.coalesce(change, F.col("previous_heart_rate")).cast("bigint"))
        assert q.broken_chains(wrong, days).count() == 1
    lost = fact.filter("NOT (user_key = 10003 AND event_date = date'2024-01-09')")
    assert [(r.user_key, str(r.event_date)) for r in q.broken_chains(lost, days).collect()] == [(10003, "2024-01-09")]
    assert q.broken_chains(fact, days).columns == ["user_key", "event_date"]
