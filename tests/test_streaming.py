import json
import os
import time

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_events, seconds
from pulselake.operators.skew import Hot
from pulselake.plans import silver
from pulselake.registry import Lake
from pulselake.sources import raw
from pulselake.streaming import jobs


def land(path, name, rows, age=None):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        for event, user, rate, at in rows:
            f.write(json.dumps({"event_id": event, "user_id": user, "heart_rate": rate,
                                "timestamp": seconds(at), "meta": json.loads(meta())}) + "\n")
    if age:
        old = time.time() - age
        os.utime(f"{path}/{name}.json", (old, old))


def test_new_files_are_appended_once(spark, path):
    def run():
        jobs.incremental_append(spark, path + "/in", path + "/t", path + "/cp", with_id=True)
        return sorted(r.event_id for r in spark.read.parquet(path + "/t").collect())

    land(path + "/in", "a", [(1, 1, 70, "2024-01-01T00:00:00")])
    assert run() == [1]
    assert run() == [1]
    land(path + "/in/2024/01/02/00", "b", [(2, 1, 71, "2024-01-02T00:00:00")])
    assert run() == [1, 2]
    row = spark.read.parquet(path + "/t").filter("event_id = 2").first()
    assert row._source_file.endswith("/in/2024/01/02/00/b.json") and row._source_modified


def test_malformed_lines_are_emitted(spark, path):
    land(path + "/in", "a", [(1, 1, 70, "2024-01-01T00:00:00")])
    with open(path + "/in/b.json", "w") as f:
        f.write("{broken\n")
    jobs.incremental_append(spark, path + "/in", path + "/t", path + "/cp", with_id=True)
    assert {r._corrupt_record for r in spark.read.parquet(path + "/t").collect()} == {None, "{broken"}


def test_a_new_file_with_an_old_date_is_loaded(spark, path):
    def run():
        jobs.incremental_append(spark, path + "/in", path + "/t", path + "/cp", with_id=True)
        return sorted(r.event_id for r in spark.read.parquet(path + "/t").collect())

    land(path + "/in", "first", [(1, 1, 70, "2024-01-01T00:00:00")])
    assert run() == [1]
    land(path + "/in", "old", [(2, 1, 70, "2024-01-01T00:00:01")], age=90 * 86400)
    assert run() == [1, 2]


def test_streamed_and_batch_appends_are_read_together(spark, path):
    lake = Lake(spark, path + "/lake")
    land(path + "/in", "a", [(1, 1, 70, "2024-01-01T00:00:00")])
    with open(path + "/in/b.json", "w") as f:
        f.write('{"event_id": 9, "user_id": 5, "heart_rate": oops\n')
    jobs.incremental_append(spark, path + "/in", lake.path("bronze", "heartrate_stream"), path + "/cp", with_id=True)
    lake.write(raw_events(spark, [(2, 1, 71, "2024-01-01T00:00:00", meta())]), "bronze", "heartrate_stream", mode="append")
    assert sorted(r.event_id for r in lake.read("bronze", "heartrate_stream").collect()) == [1, 2]
    assert [r._corrupt_record for r in lake.rejected("bronze", "heartrate_stream").collect()] == [
        '{"event_id": 9, "user_id": 5, "heart_rate": oops']


def test_late_and_untimed_readings_are_counted_and_reconciled(spark, path):
    job = jobs.PreviousReading(spark, path + "/job", delay=60)
    batches = [[(1, 1, 70, "2024-01-02T00:00:00", meta()), (2, 1, 71, "2024-01-02T01:00:00", meta())],
               [(3, 1, 72, "2024-01-01T00:00:00", meta()), (4, 1, 73, None, meta())]]
    for i, batch in enumerate(batches):
        job.process(silver.heart_rate(raw_events(spark, batch)), i)
    job.finish(1)
    assert {r.part: r.readings for r in job.counts().collect()} == {"out": 2, "late": 1, "untimed": 1}
    got = {r.event_id: r.previous_heart_rate for r in job.reconciled().collect()}
    assert len(got) == 4 and got[1] == 72 and got[2] == 70


def test_history_look_back(spark, path):
    def run():
        jobs.incremental_append(spark, path + "/in", path + "/t", path + "/cp", with_id=True, max_age="3d")
        return sorted(r.event_id for r in spark.read.parquet(path + "/t").collect())

    day = 86400
    land(path + "/in", "first", [(1, 1, 70, "2024-01-01T00:00:00")], age=30 * day)
    land(path + "/in", "second", [(2, 1, 70, "2024-01-01T00:00:01")], age=day)
    assert run() == [1, 2]  # the first run takes all
    land(path + "/in", "too old", [(3, 1, 70, "2024-01-01T00:00:02")], age=10 * day)
    land(path + "/in", "in reach", [(4, 1, 70, "2024-01-01T00:00:03")], age=2 * day)
    assert run() == [1, 2, 4]


def stream(spark, path, max_files=1000):
    return jobs.flatten(raw.stream_jsonl(spark, path, with_id=True, max_files=max_files))


def test_copies_across_batches_are_dropped(spark, path):
    for part in ("a", "b"):
        land(path + "/in", part, [(1, 1, 70, "2024-01-01T00:00:00"), (2, 1, 71, "2024-01-01T00:00:10")])
        jobs.drain(jobs.dedup(stream(spark, path + "/in"), Lake(spark, path + "/lake")), path + "/cp")
    land(path + "/in", "late", [(3, 1, 72, "2023-12-28T00:00:00")])  # days before all others
    jobs.drain(jobs.dedup(stream(spark, path + "/in"), Lake(spark, path + "/lake")), path + "/cp")
    got = Lake(spark, path + "/lake").read("silver", "heart_rate_cleaned").collect()
    assert sorted(r.event_id for r in got) == [1, 2, 3]


def test_open_days_have_statistics_too(spark, path):
    land(path + "/in", "a", [(1, 1, 70, "2024-01-01T10:00:00"), (2, 1, 80, "2024-01-01T11:00:00"),
                             (3, 1, 99, "2024-01-02T10:00:00")])
    jobs.drain(jobs.daily_stats(stream(spark, path + "/in"), Lake(spark, path + "/lake"), path + "/out"), path + "/cp")
    got = sorted((str(r.event_date), r.max_heart_rate, r.min_heart_rate, r.avg_heart_rate)
                 for r in spark.read.parquet(path + "/out").collect())
    assert got == [("2024-01-01", 80, 70, 75.0), ("2024-01-02", 99, 99, 99.0)]


def test_stream_lake_sink_directories(spark, path):
    land(path + "/in", "a", [(1, 1, 70, "2024-01-01T10:59:59")])
    events = raw.stream_jsonl(spark, path + "/in", with_id=True)
    jobs.drain(jobs.to_lake(events, path + "/lake"), path + "/cp")
    assert os.path.isdir(path + "/lake/year=2024/month=01/day=01/hour=10")


def test_topic_messages_decode_like_files(spark, path):
    events = raw_events(spark, [(1, 1, 70, "2024-01-01T00:00:00", meta())])
    raw.encode_events(events).write.parquet(path + "/topic")
    messages = spark.readStream.schema("key string, value string").parquet(path + "/topic")
    rows = jobs.flatten(raw.decode_events(messages, with_id=True))
    jobs.drain(jobs.to_parquet(rows, path + "/out"), path + "/cp")
    assert spark.read.parquet(path + "/out").first().activity_id == 20683


@pytest.mark.parametrize("hot", [Hot(), Hot([1], 1)])
def test_previous_value_with_disorder_across_batches(spark, path, hot):
    job = jobs.PreviousReading(spark, path + "/job", delay=600, hot=hot)
    files = [
        [(1, 1, 60, "2024-01-01T00:00:00"), (3, 1, 62, "2024-01-01T00:05:00"), (9, 2, 90, "2024-01-01T00:00:30")],
        [(2, 1, 61, "2024-01-01T00:04:00"), (4, 1, 63, "2024-01-01T00:20:00")],      # 2 is late, in reach
        [(6, 1, 65, "2024-01-01T00:19:00"), (5, 1, 64, "2024-01-01T00:19:00"), (8, 2, 91, "2024-01-01T01:00:00")],
        [(7, 1, 66, "2024-01-01T00:01:00")],                                          # out of reach
    ]
    query = None
    for n, rows in enumerate(files):
        land(path + "/in", f"f{n}", rows)
        query = jobs.drain(job.writer(stream(spark, path + "/in")), path + "/cp")
    job.finish(query.lastProgress["batchId"])
    got = {r.event_id: r.previous_heart_rate for r in job.result().collect()}
    assert got == {1: None, 2: 60, 3: 61, 5: 62, 6: 64, 4: 65, 9: None, 8: 90}
    late = spark.read.parquet(path + "/job/late").collect()
    assert [r.event_id for r in late] == [7]


def test_a_batch_run_twice_changes_nothing(spark, path):
    job = jobs.PreviousReading(spark, path + "/job", delay=60)
    one = silver.heart_rate(raw_events(spark, [(1, 1, 60, "2024-01-01T00:00:00", meta()),
                                               (2, 1, 61, "2024-01-01T00:05:00", meta())]))
    two = silver.heart_rate(raw_events(spark, [(3, 1, 62, "2024-01-01T00:06:00", meta())]))
    for _ in range(2):
        job.process(one, 0)
    for _ in range(3):
        job.process(two, 1)
    job.process(two.limit(0), 2)
    for n in range(2):
        job.finish(2)
    got = sorted((r.event_id, r.previous_heart_rate) for r in job.result().collect())
    assert got == [(1, None), (2, 60), (3, 61)]


def test_old_state_is_forgotten(spark, path):
    job = jobs.PreviousReading(spark, path + "/job", delay=0)
    for n in range(6):
        rows = raw_events(spark, [(n, 1, 60 + n, f"2024-01-01T00:0{n}:00", meta())])
        job.process(silver.heart_rate(rows), n)
    assert sorted(os.listdir(path + "/job/state/last")) == ["batch=3", "batch=4", "batch=5"]
    job.finish(5)
    got = [r.previous_heart_rate for r in job.result().orderBy("event_id").collect()]
    assert got == [None, 60, 61, 62, 63, 64]


def test_comparison_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k long, v string")
    assert tuple(jobs.differing_rows(a, b).first()) == (3, 3, 2)
    assert tuple(jobs.differing_rows(a, a).first()) == (3, 3, 0)
    assert tuple(jobs.differing_rows(a.limit(0), b.limit(0)).first()) == (0, 0, 0)


def test_stream_and_batch_share_the_transform(spark, path):
    rows = [(i, i % 3, 60 + i, f"2024-01-01T00:{i:02d}:00") for i in range(30)]
    for n in range(3):
        land(path + "/in", f"f{n}", rows[n::3])
    jobs.drain(jobs.to_parquet(stream(spark, path + "/in", max_files=1), path + "/out"), path + "/cp")
    batch = silver.heart_rate(raw.read_jsonl(spark, path + "/in", with_id=True).drop(raw.CORRUPT))
    report = jobs.differing_rows(spark.read.parquet(path + "/out"), batch).first()
    assert tuple(report) == (30, 30, 0)
    assert batch.select(F.max("event_id")).first()[0] == 29
