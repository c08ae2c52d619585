import datetime

from pyspark.sql import functions as F

from frames import meta, raw_events
from pulselake.operators import keys
from pulselake.plans import silver

D = datetime.date


def test_copies_vanish_and_equal_readings_of_others_stay(spark):
    row = (1, 10001, 70, "2024-01-01T00:00:00", meta())
    hr = silver.heart_rate(raw_events(spark, [row, row, row, (2, *row[1:]), (1, 10002, *row[2:])]))
    assert keys.dedup_events(hr).count() == 3


def test_of_differing_copies_one_that_was_sent_stays_in_any_order(spark):
    rows = [(1, 1, 70, "2024-01-01T00:00:00", "{"), (1, 1, 72, "2024-01-01T00:00:00", meta()),
            (1, 1, 71, "2024-01-01T00:00:00", meta())]
    got = {str(keys.dedup_events(silver.heart_rate(raw_events(spark, order)).repartition(n)).collect())
           for order in (rows, rows[::-1]) for n in (1, 3)}
    assert len(got) == 1
    kept = got.pop()
    assert "heart_rate=70" in kept and "latitude=None" in kept  # not merged with the others' coordinates
    hr = silver.heart_rate(raw_events(spark, rows))
    assert [(r.user_id, r.event_id, r.versions) for r in keys.conflicting_events(hr.union(hr)).collect()] == [(1, 1, 3)]


def test_a_known_value_goes_before_null(spark):
    rows = [(1, 1, None, "2024-01-01T00:00:00", meta()), (1, 1, 90, "2024-01-01T00:00:00", meta())]
    assert [r.heart_rate for r in keys.dedup_events(silver.heart_rate(raw_events(spark, rows))).collect()] == [90]


def test_dedup_combines_map_side(spark):
    hr = silver.heart_rate(raw_events(spark, [(1, 1, 70, "2024-01-01T00:00:00", meta())]))
    plan = keys.dedup_events(hr)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1


def test_surrogate_key_is_stable_and_tells_versions_apart(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (2, D(2024, 1, 1))], "id long, d date")
    for algorithm in ("xxhash64", "md5"):
        key = keys.surrogate_key("id", "d", algorithm=algorithm)
        first = {(r.id, r.d): r.k for r in df.select("*", key.alias("k")).collect()}
        again = {(r.id, r.d): r.k for r in df.repartition(3).select("*", key.alias("k")).collect()}
        assert first == again and len(set(first.values())) == 3


def snapshots(spark, rows):
    return spark.createDataFrame(rows, "user_id long, at string, n long, city string").select(
        "*", F.to_date("at").alias("day"))


def test_history_opens_a_version_only_on_change(spark):
    df = snapshots(spark, [
        (1, "2024-01-01", 1, "Oslo"), (1, "2024-01-05", 2, "Oslo"),
        (1, "2024-02-01", 3, "Rome"), (1, "2024-02-01", 4, "Bern"),
        (1, "2024-03-01", 5, None), (1, "2024-04-01", 6, None),
        (1, "2024-05-01", 7, "Oslo"), (2, "2024-01-01", 8, None)])
    got = sorted((r.user_id, r.start_date, r.end_date or D.max, r.city)
                 for r in keys.scd2_history(df, "user_id", ["at", "n"], "day", ["city"]).collect())
    assert got == [
        (1, D(2024, 1, 1), D(2024, 2, 1), "Oslo"),
        (1, D(2024, 2, 1), D(2024, 3, 1), "Bern"),
        (1, D(2024, 3, 1), D(2024, 5, 1), None),
        (1, D(2024, 5, 1), D.max, "Oslo"),
        (2, D(2024, 1, 1), D.max, None)]


def test_latest_ties_are_settled_the_same_way_every_time(spark):
    df = spark.createDataFrame([(1, "t", 5), (1, "t", 9), (1, "s", 99)], "id long, at string, v long")
    assert {keys.dedup_latest(df.repartition(n), "id", "at").first().v for n in (1, 2, 3)} == {9}


def test_history_merged_in_steps_equals_history_built_at_once(spark):
    rows = [(u, f"2024-{m:02d}-{d:02d}", u * 1000 + m * 31 + d, "ABC"[(u * m + d // 9) % 3])
            for u in range(6) for m in range(1, 7) for d in (1, 10, 28)]
    df = snapshots(spark, rows)
    how = ("user_id", ["at", "n"], "day", ["city"])
    merged = keys.scd2_history(df.filter("day < '2024-02-15'"), *how)
    for low, high in (("2024-02-15", "2024-05-01"), ("2024-05-01", "2025-01-01")):
        merged = keys.scd2_merge(merged, df.filter(f"day >= '{low}' and day < '{high}'"), *how)
    want = sorted(map(str, keys.scd2_history(df, *how).collect()))
    assert sorted(map(str, merged.collect())) == want


def test_a_correction_on_the_same_day_replaces_the_version(spark):
    how = ("user_id", ["at", "n"], "day", ["city"])
    history = keys.scd2_history(snapshots(spark, [(1, "2024-01-01", 1, "Oslo"), (1, "2024-02-01", 2, "Rome")]), *how)
    merged = keys.scd2_merge(history, snapshots(spark, [(1, "2024-02-01", 3, "Bern")]), *how)
    assert sorted((r.city, r.start_date, r.end_date) for r in merged.collect()) == [
        ("Bern", D(2024, 2, 1), None), ("Oslo", D(2024, 1, 1), D(2024, 2, 1))]
