import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_events
from pulselake.operators import ordered
from pulselake.operators.skew import Hot
from pulselake.plans import gold, silver


def readings(spark, n, seed, one_second=False):
    """User 1 has a third of the rows, half of those in a single second."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if i % 3 == 0 else rng.randint(2, 9)
        at = 0 if (user == 1 and (one_second or i % 2)) else rng.randint(0, 200_000)
        rate = None if rng.random() < 0.05 else rng.randint(40, 205)
        rows.append((i * 7919 % 100_003, user, rate, at, rng.choice([20683, 20470, None])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id long, user_id long, heart_rate long, s long, activity_id long")
    return rows, df.select("user_id", "heart_rate", F.timestamp_seconds("s").alias("event_timestamp"),
                           "activity_id", F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), "event_id")


def expected(rows):
    previous, groups, last = {}, defaultdict(list), {}
    for event, user, rate, at, activity in sorted(rows, key=lambda r: (r[1], r[3], r[0])):
        previous[event] = last.get(user)
        last[user] = rate
        groups[(user, activity, at // 86400)].append(rate)
    out = {}
    for event, user, rate, at, activity in rows:
        values = [v for v in groups[(user, activity, at // 86400)] if v is not None]
        stats = (max(values), min(values), sum(values) / len(values)) if values else (None, None, None)
        out[event] = (previous[event], *stats)
    return out


@pytest.mark.parametrize("hot", [
    Hot(), Hot([1], 10), Hot([1], 1_000_000), Hot([1, 2, 3], 3), Hot(list(range(1, 10)), 1), Hot([404], 5)])
@pytest.mark.parametrize("one_second", [False, True])
def test_fact_equals_brute_force_whatever_is_hot(spark, hot, one_second):
    rows, df = readings(spark, 900, 7, one_second)
    fact = gold.fact_rows(df, hot)
    got = {r.event_id: (r.previous_heart_rate, r.max_heart_rate, r.min_heart_rate, r.avg_heart_rate)
           for r in fact.collect()}
    assert len(got) == len(rows)
    assert got == expected(rows)


def test_previous_alone_and_statistics_alone(spark):
    rows, df = readings(spark, 400, 3)
    want = expected(rows)
    for hot in (None, Hot([1, 5], 4)):
        lag = ordered.with_previous(df, "user_id", "event_timestamp", "event_id", "heart_rate", "p", hot)
        assert {r.event_id: r.p for r in lag.collect()} == {e: w[0] for e, w in want.items()}
        day = df.withColumn("event_date", F.to_date("event_timestamp"))
        stats = ordered.with_group_stats(day, ["user_id", "activity_id", "event_date"],
                                         {"m": F.max("heart_rate")}, hot)
        assert {r.event_id: r.m for r in stats.collect()} == {e: w[1] for e, w in want.items()}


def test_hot_list_longer_than_a_filter(spark):
    rows, df = readings(spark, 300, 5)
    hot = Hot(list(range(1, 2000)), 2)
    lag = ordered.with_previous(df, "user_id", "event_timestamp", "event_id", "heart_rate", "p", hot)
    assert {r.event_id: r.p for r in lag.collect()} == {e: w[0] for e, w in expected(rows).items()}


@pytest.mark.parametrize("hot", [Hot(), Hot([1], 1)])
def test_extreme_event_ids_keep_their_order(spark, hot):
    ids = [-2**63, -2**62, -1, 0, 1, 2**62, 2**63 - 2, 2**63 - 1]
    df = spark.createDataFrame([(1, i, n) for n, i in enumerate(ids)], "k long, event_id long, v long") \
        .withColumn("ts", F.timestamp_seconds(F.lit(5)))
    got = {r.event_id: r.p for r in ordered.with_previous(df, "k", "ts", "event_id", "v", "p", hot).collect()}
    assert [got[i] for i in ids] == [None, 0, 1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("hot", [Hot(), Hot([1], 1), Hot([1], 100)])
def test_missing_times_and_ids_come_first(spark, hot):
    rows = [(1, None, None, 1), (1, None, 5, 2), (1, None, 9, 3), (1, -4000, None, 4), (1, -4000, -3, 5),
            (1, 0, 1, 6), (1, 0, 2, 7), (1, 7200, 0, 8)]
    df = spark.createDataFrame(rows, "k long, s long, id long, v long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.v: r.p for r in ordered.with_previous(df.repartition(3), "k", "ts", "id", "v", "p", hot).collect()}
    assert got == {1: None, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 6, 8: 7}


def test_a_single_reading_and_one_second_ties(spark):
    hr = silver.heart_rate(raw_events(spark, [
        (1, 10001, 70, "2024-01-01T00:00:00", meta()),
        (3, 10002, 90, "2024-01-01T00:00:00", meta()),
        (2, 10002, 80, "2024-01-01T00:00:00", meta()),
        (4, 10002, 85, "2024-01-02T00:00:00", meta())]))
    got = {r.event_id: r.previous_heart_rate for r in gold.fact_rows(hr).collect()}
    assert got == {1: None, 2: None, 3: 80, 4: 90}


def test_plain_fact_shuffles_once(spark):
    _, df = readings(spark, 50, 1)
    df.write.mode("overwrite").format("noop").save()
    plan = gold.fct_heart_rate(df, Hot())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_crowded_second_is_cut_evenly_whatever_its_ids(spark):
    native = [(1, 100, i, 7) for i in range(1, 1501)]  # small ids of a source beside derived ones
    derived = [(1, 100, (i * 6364136223846793005 + 1442695040888963407) % 2**64 - 2**63, 7) for i in range(1500)]
    others = [(1, 200 + i, i, 7) for i in range(300)] + [(1, 9000, 5, 7)]
    df = spark.createDataFrame(native + derived + others, "k long, s long, id long, v long").withColumn(
        "ts", F.timestamp_seconds("s")).repartition(5)
    limit = 150
    sliced = ordered._slices(df, "k", "ts", "id", limit)
    counts = {(r._hour, r._instant, r._part): r["count"] for r in sliced.groupBy("_hour", "_instant", "_part").count().collect()}
    second = [n for (_, instant, _), n in counts.items() if instant == 100 * 10**6]
    assert sum(second) == 3000 and max(second) < 2 * limit and len(second) > 20
    assert counts[2, 0, 0] == 1  # an hour with few rows stays whole
    values = df.withColumn("v", F.xxhash64("id"))
    got = ordered.with_previous(values, "k", "ts", "id", "v", "p", Hot([1], limit))
    want = ordered.with_previous(values, "k", "ts", "id", "v", "p", Hot())
    assert got.exceptAll(want).count() == 0 and got.count() == 3301
