"""Versions of users and activities: merges in any order, and the fact's keys."""

import datetime
import itertools

from pyspark.sql import functions as F

from frames import meta, raw_activities, raw_events, raw_users
from pulselake.operators import keys
from pulselake.operators.skew import Hot
from pulselake.plans import gold, refresh, silver
from pulselake.registry import Lake

D = datetime.date


def user(day, address, userid=10001):
    return {"userid": userid, "address": address, "last_update": f"{day}T08:00:00Z"}


def spans(history):
    return sorted((r.user_id, str(r.start_date), str(r.end_date), r.address) for r in history.collect())


def test_a_late_snapshot_cuts_the_version_it_falls_into(spark):
    days = [("2024-01-01", "A"), ("2024-01-03", "A"), ("2024-01-05", "B")]
    known = silver.users_history(silver.user_snapshots(raw_users(spark, [user(*d) for d in days])))
    merged = silver.users_history(silver.user_snapshots(raw_users(spark, [user("2024-01-02", "C")])), known)
    assert spans(merged) == [(10001, "2024-01-01", "2024-01-02", "A"), (10001, "2024-01-02", "2024-01-03", "C"),
                             (10001, "2024-01-03", "2024-01-05", "A"), (10001, "2024-01-05", "None", "B")]


def test_merges_in_any_order_equal_the_rebuilt_history(spark):
    snapshots = [user("2024-01-01", "A"), user("2024-01-03", "A"), user("2024-01-05", "B"), user("2024-01-02", "C"),
                 user("2024-01-04", "x", 10002)]
    want = rows(silver.users_history(silver.user_snapshots(raw_users(spark, snapshots))))
    for order in list(itertools.permutations(range(5)))[::37]:
        history = None
        for i in order:
            history = silver.users_history(silver.user_snapshots(raw_users(spark, [snapshots[i]])), history)
            history = spark.createDataFrame(history.collect(), history.schema)
        assert rows(history) == want
    again = silver.users_history(silver.user_snapshots(raw_users(spark, snapshots[:2])), history)
    assert rows(again) == want


def rows(df):
    return sorted(map(str, df.collect()))


def test_records_of_other_users_stay_untouched(spark):
    known = silver.users_history(silver.user_snapshots(raw_users(spark, [user("2024-01-01", "A"), user("2024-01-01", "Q", 7)])))
    merged = silver.users_history(silver.user_snapshots(raw_users(spark, [user("2024-02-01", "B")])), known)
    assert rows(merged.filter("user_id = 7")) == rows(known.filter("user_id = 7"))
    old, new = (spark.createDataFrame(h.collect(), h.schema) for h in (known, merged))
    changed = {(r.user_id, r.from_day, r.to_day) for r in keys.changed_versions(old, new, "user_id", "user_sk").collect()}
    assert changed == {(10001, None, None), (10001, None, D(2024, 2, 1)), (10001, D(2024, 2, 1), None)}


def test_version_on_a_day(spark):
    history = silver.users_history(silver.user_snapshots(raw_users(spark, [user("2024-01-02", "A"), user("2024-01-05", "B")])))
    by_key = keys.versions_by_key(history, "user_id", "user_sk")
    names = {r.user_sk: r.address for r in history.collect()}
    days = [D(2023, 1, 1), D(2024, 1, 2), D(2024, 1, 4), D(2024, 1, 5), D(2030, 1, 1)]
    got = by_key.select(*[keys.version_on(F.lit(d), F.col("versions")) for d in days]).first()
    assert [names[k] for k in got] == ["A", "A", "A", "B", "B"]


def reading(event, user_id, day):
    return (event, user_id, 60 + event, f"{day}T00:00:00", meta())


def fact_versions(lake):
    names = {r.user_sk: r.address for r in lake.read("gold", "dim_users_history").collect()}
    rows_ = lake.read("gold", "fct_heart_rate", extra=("user_sk", "activity_sk")).collect()
    activities = {r.activity_sk for r in lake.read("gold", "dim_activities_history").collect()}
    assert all(r.activity_sk in activities for r in rows_ if r.activity_id == 20683)
    return {(r.user_key, str(r.event_date)): names.get(r.user_sk) for r in rows_}


def test_the_fact_carries_the_version_of_its_day_also_when_it_arrives_late(spark, path):
    lake = Lake(spark, path)
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09"]
    lake.write(raw_users(spark, [user("2024-01-01", "A"), user("2024-01-03", "A"), user("2024-01-05", "B"), user("2024-01-01", "Z", 10002)]),
               "bronze", "raw_users")
    lake.write(raw_activities(spark), "bronze", "raw_activities")
    lake.write(raw_events(spark, [reading(i + 10 * u, 10001 + u, d) for u in range(3) for i, d in enumerate(days)]),
               "bronze", "heartrate_stream")
    refresh.full_refresh(lake)
    want = {(10001, d): "A" if d < "2024-01-05" else "B" for d in days} | {(10002, d): "Z" for d in days} | {
        (10003, d): None for d in days}
    assert fact_versions(lake) == want
    before = lake._manifest().current()[1]["gold.fct_heart_rate"]

    lake.write(raw_users(spark, [user("2024-01-02", "C")]), "bronze", "raw_users")  # the next file, a late snapshot
    tomorrow = datetime.date.today() + datetime.timedelta(days=1)
    refresh.incremental_refresh(lake, arrived_since=tomorrow)  # no reading arrived
    assert fact_versions(lake) == want | {(10001, "2024-01-02"): "C"}
    after = lake._manifest().current()[1]["gold.fct_heart_rate"]
    # The first version ends earlier now, and what was its end is a version of its own: days 1 and 2 to 4.
    assert after["event_date=2024-01-09"] == before["event_date=2024-01-09"]
    assert after["event_date=2024-01-02"] != before["event_date=2024-01-02"]
    refresh.full_refresh(lake)  # keeps what earlier files showed
    assert fact_versions(lake) == want | {(10001, "2024-01-02"): "C"}


def test_hot_users_get_the_same_keys(spark):
    hr = silver.heart_rate(raw_events(spark, [reading(i * 10 + u, 10001 + u, f"2024-01-{i + 1:02d}") for u in range(3) for i in range(6)]))
    users = silver.users_history(silver.user_snapshots(raw_users(spark, [user("2024-01-02", "A"), user("2024-01-04", "B"), user("2024-01-03", "Q", 10002)])))
    activities = silver.activities_history(silver.activity_snapshots(raw_activities(spark)))
    last = silver.last_readings(hr)
    got = [rows(gold.fact_by_day(hr, last, hot=hot, users=users, activities=activities)) for hot in (Hot(), Hot([10001, 10002], 1))]
    assert got[0] == got[1] and len(got[0]) == 18
