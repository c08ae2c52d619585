import datetime
import os

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_activities, raw_events, raw_users, seconds
from pulselake.operators.quality import QualityError
from pulselake.operators.skew import Hot
from pulselake.plans import dims, gold, refresh, silver
from pulselake.registry import Lake
from pulselake.streaming.jobs import differing_rows

DAY = datetime.date(2024, 1, 2)


def events(spark, days, start=0):
    rows = []
    for d in days:
        for i in range(20):
            n = start + d * 100 + i
            rows.append((n, 10001 + i % 4, 50 + (n * 37) % 150, f"2024-01-{d:02d}T{i:02d}:00:{i:02d}", meta()))
    return raw_events(spark, rows)


def bronze(spark, path, raw, users=None):
    lake = Lake(spark, path)
    lake.write(users or raw_users(spark, [{"userid": u} for u in range(10001, 10005)]), "bronze", "raw_users")
    lake.write(raw_activities(spark), "bronze", "raw_activities")
    lake.write(raw, "bronze", "heartrate_stream")
    return lake


def rows(df):
    return sorted(map(str, df.collect()))


def test_full_refresh_builds_gold_and_can_be_repeated(spark, path):
    raw = events(spark, [1, 2])
    lake = bronze(spark, path, raw.union(raw))  # every event delivered twice
    first = rows(refresh.full_refresh(lake))
    assert len(first) == 40
    assert first == rows(gold.fct_heart_rate(silver.heart_rate(raw)))
    assert rows(refresh.full_refresh(lake)) == first
    assert lake.read("gold", "dim_date").count() == 1096
    for key in refresh.DIMENSIONS:
        assert rows(lake.read("gold", key)) == rows(lake.read("silver", key))


def test_a_failing_check_blocks_gold(spark, path):
    lake = bronze(spark, path, events(spark, [1]), raw_users(spark, [{"dob": 19991340}]))
    with pytest.raises(QualityError, match="date_of_birth"):
        refresh.full_refresh(lake)
    assert not os.path.exists(path + "/gold")


def test_readings_that_break_a_rule_are_set_aside_and_the_rest_loads(spark, path):
    late = seconds("2024-01-01T00:00:00") * 1000  # an epoch in milliseconds
    bad = raw_events(spark, [(1, 10001, 70, "2024-01-01T00:00:00", meta(latitude=90.1)),
                             (2, 10001, 70, "2024-01-01T00:00:00", meta())])
    bad = bad.withColumn("timestamp", F.when(F.col("event_id") == 2, F.lit(late)).otherwise(F.col("timestamp")))
    lake = bronze(spark, path, events(spark, [1]).union(bad))
    assert refresh.full_refresh(lake).count() == 20
    got = {r.event_id: r.failed_rules for r in lake.read("silver", "heart_rate_rejected").collect()}
    assert got == {1: ["range(latitude)"], 2: ["castable(event_timestamp,timestamp)"]}


@pytest.mark.parametrize("name", ["heart_rate", "users"])
def test_a_raw_record_is_cleaned_once_however_many_tables_it_goes_to(spark, path, monkeypatch, name):
    seen, clean = spark.sparkContext.accumulator(0), getattr(silver, name)

    def counted(raw, keep=()):
        rows = clean(raw, keep)

        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(run, rows.schema)

    lake = bronze(spark, path, events(spark, [1]))
    monkeypatch.setattr(refresh.silver, name, counted)
    refresh.build_silver(lake)
    assert seen.value == {"heart_rate": 20, "users": 4}[name]


def test_an_increment_takes_late_readings_and_new_users(spark, path):
    users = [{"userid": u} for u in range(10001, 10005)]
    lake = bronze(spark, path, events(spark, [1, 3]), raw_users(spark, users[:2]))
    refresh.full_refresh(lake)
    lake.write(raw_users(spark, users), "bronze", "raw_users")
    lake.write(events(spark, [2, 4], start=5000), "bronze", "heartrate_stream", mode="append")
    assert refresh.incremental_refresh(lake, arrived_since=datetime.date.today() - datetime.timedelta(1)) is not None
    want = gold.fct_heart_rate(silver.heart_rate(events(spark, [1, 3]).union(events(spark, [2, 4], start=5000))), Hot())
    assert rows(lake.read("gold", "fct_heart_rate")) == rows(want)
    assert lake.read("gold", "dim_users").count() == 4


def test_checks_of_an_increment_read_its_days_only(spark, path):
    lake = bronze(spark, path, events(spark, [1, 2, 3]))
    refresh.full_refresh(lake)
    fact = lake.read("gold", "fct_heart_rate", f"event_date >= date'{DAY}'")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    wrong = lake.read("gold", "fct_heart_rate", "event_date < date'2024-01-02'").withColumn(
        "max_heart_rate", F.lit(999).cast("bigint"))
    lake.write(spark.createDataFrame(wrong.collect(), wrong.schema), "gold", "fct_heart_rate", only_partitions=True)
    refresh.check_gold(lake, DAY)  # a fault before the increment is not its business
    with pytest.raises(QualityError):
        refresh.check_gold(lake)


def test_publish_is_blocked_by_its_rules(spark, path):
    lake = Lake(spark, path)
    lake.write(silver.users(raw_users(spark, [{"dob": None}])), "silver", "dim_users")
    with pytest.raises(QualityError):
        refresh.publish(lake, "dim_users")
    refresh.publish(lake, "dim_users", rules=[])
    assert lake.read("gold", "dim_users").count() == 1


def test_gold_checks_find_a_wrong_fact(spark, path):
    lake = bronze(spark, path, events(spark, [1]))
    refresh.full_refresh(lake)
    fact = lake.read("gold", "fct_heart_rate")
    wrong = fact.withColumn("max_heart_rate", F.col("max_heart_rate") + 1)
    lake.write(spark.createDataFrame(wrong.collect(), fact.schema), "gold", "fct_heart_rate")
    with pytest.raises(QualityError, match="daily statistics"):
        refresh.check_gold(lake)


@pytest.mark.parametrize("hot", [Hot(), Hot([10001], 2)])
def test_incremental_equals_full(spark, path, hot):
    everything = events(spark, [1, 2, 3]).union(events(spark, [2], start=5000))
    lake = bronze(spark, path, events(spark, [1, 2]))
    refresh.build_silver(lake)
    refresh.build_gold(lake, hot=hot)
    before = os.listdir(path + "/gold/fct_heart_rate/event_date=2024-01-01")
    arrived = silver.heart_rate(everything).filter(F.to_date("event_timestamp") >= F.lit(DAY))
    assert refresh.merge_readings(lake, arrived) == DAY  # days 2 and 3 arrive, 2 in part again
    refresh.build_gold(lake, DAY, hot)
    want = gold.fct_heart_rate(silver.heart_rate(everything), Hot())
    assert tuple(differing_rows(lake.read("gold", "fct_heart_rate"), want).first()) == (80, 80, 0)
    # Days before the cut are left as they were.
    assert os.listdir(path + "/gold/fct_heart_rate/event_date=2024-01-01") == before


@pytest.mark.parametrize("hot", [Hot(), Hot([10001, 10003], 1)])
def test_fact_by_day_equals_fact_and_shuffles_readings_once(spark, hot):
    hr = silver.heart_rate(events(spark, [1, 2, 5]).union(raw_events(spark, [
        (900, 10001, None, "2024-01-02T23:59:59", "{"), (901, 10001, 99, "2024-01-05T00:00:00", "{"),
        (902, 10001, 98, "2024-01-05T00:00:00", meta())])))
    fact = gold.fact_by_day(hr, silver.last_readings(hr), hot=hot)
    if not hot:
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") == 1
        assert plan.count("Exchange hashpartitioning") == 3  # two of them move user-days only
    assert rows(fact) == rows(gold.fct_heart_rate(hr, Hot()))


def test_a_heavy_day_is_cut_into_more_cells(spark):
    rows = [(1, "2024-01-01")] * 90 + [(1, "2024-01-02")] * 9 + [(1, None)]
    df = spark.createDataFrame(rows, "k long, d string").select(F.col("d").cast("date").alias("event_date"))
    cells = {str(r.event_date): r._cells for r in gold.cells_by_day(df).collect()}
    assert cells == {"2024-01-01": 15, "2024-01-02": 2, "None": 1}  # of 4 x 4 wanted
    assert gold.cells_by_day(df.limit(0)).count() == 0


def test_fact_by_day_of_no_or_timeless_readings(spark):
    hr = silver.heart_rate(raw_events(spark, [
        (1, 1, 70, None, meta()), (2, 1, 71, "2024-01-02T00:00:00", meta()), (3, 2, 60, None, meta())]))
    want = rows(gold.fct_heart_rate(hr, Hot()))
    assert rows(gold.fact_by_day(hr, silver.last_readings(hr), hot=Hot())) == want
    none = hr.limit(0)
    assert gold.fact_by_day(none, silver.last_readings(none), hot=Hot()).count() == 0


def test_the_fact_has_a_row_per_reading_whatever_the_dimensions_hold(spark):
    hr = silver.heart_rate(events(spark, [1]))
    users = raw_users(spark, [{"userid": 10001}, {"userid": 10001, "weight": 61}, {"userid": 77}])
    fact = gold.fact_rows(hr)
    star = gold.star(fact, silver.latest_users(users), silver.latest_activities(raw_activities(spark)),
                     dims.dim_date(spark), dims.dim_time(spark))
    assert star.count() == hr.count() == 20
    assert rows(star.select(*fact.columns)) == rows(fact)
    assert star.filter("gender is not null").count() == 5
    assert star.filter("time_category is null or day_name is null").count() == 0


def test_bounded_dimension_joins_are_broadcast(spark):
    hr = silver.heart_rate(events(spark, [1]))
    joined = gold.join_time(gold.join_date(gold.base(hr), dims.dim_date(spark), ["day_name"]),
                            dims.dim_time(spark), ["time_category"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan
