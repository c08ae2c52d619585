"""What a streaming batch writes: its own days and buckets of users, no others."""

import os

import pytest
from pyspark.sql import functions as F

from frames import meta, raw_events
from pulselake.operators.skew import Hot
from pulselake.plans import refresh, silver
from pulselake.registry import Lake
from pulselake.sources import raw
from pulselake.streaming import jobs


def batch(spark, *rows):
    return silver.heart_rate(raw_events(spark, [(e, u, r, t, meta()) for e, u, r, t in rows]))


def files(path):
    return {os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns
            for at, _, names in os.walk(path) for n in names if n.startswith("part-")}


def run(job, df, n):
    """What ``foreachBatch`` would call."""
    calls = []
    class Stream:
        @property
        def writeStream(self):
            return self
        def foreachBatch(self, f):
            calls.append(f)
    job(Stream())
    calls[0](df, n)


FIRST = [(u, u, 60 + u, f"2024-01-0{1 + u % 3}T00:00:00") for u in range(40)]


def test_one_late_reading_writes_one_bucket(spark, path):
    lake, out = Lake(spark, path + "/lake"), path + "/out"
    run(lambda s: jobs.daily_stats(s, lake, out), batch(spark, *FIRST), 0)
    before, stats = files(path + "/lake"), files(out)
    assert len(stats) > 8
    late = batch(spark, (100, 5, 200, "2024-01-03T05:00:00"))
    run(lambda s: jobs.daily_stats(s, lake, out), late, 1)
    added, kept = set(files(path + "/lake")) - set(before), files(path + "/lake")
    assert {f: kept[f] for f in before} == before and len(added) == 1
    after = files(out)
    changed = {os.path.dirname(f) for f in set(after) ^ set(stats)}
    assert len(changed) == 1 and "event_date=2024-01-03/bucket=" in changed.pop()
    run(lambda s: jobs.daily_stats(s, lake, out), late, 1)  # the batch once more
    got = jobs.read_daily_stats(spark, out).filter("user_id = 5").collect()
    assert [(r.max_heart_rate, r.min_heart_rate, r.avg_heart_rate) for r in got] == [(200, 65, 132.5)]
    assert jobs.read_daily_stats(spark, out).count() == 40


def test_deltas_are_merged_on_read_and_by_compaction(spark, path):
    lake = Lake(spark, path)
    lake.write(batch(spark, *FIRST), "silver", "heart_rate_cleaned")
    again = batch(spark, *FIRST[:5], (200, 1, 99, "2024-01-02T10:00:00"), (201, 1, 98, "2023-05-05T10:00:00"))
    for n in range(2):
        run(lambda s: jobs.dedup(s, lake), again, n)
    ids = lambda: sorted(r.event_id for r in lake.read("silver", "heart_rate_cleaned").collect())
    want = sorted([*range(40), 200, 201])
    assert ids() == want
    untouched = lake.read("silver", "heart_rate_cleaned", "event_day = date'2024-01-03'")
    assert untouched.count() == 13
    assert [str(d) for d in refresh.compact(lake)] == ["2023-05-05", "2024-01-01", "2024-01-02", "2024-01-03"]
    assert ids() == want and lake.delta_leaves("heart_rate_cleaned") == [] and refresh.compact(lake) == []
    last = {r.event_id for r in lake.read("silver", "last_readings").filter("user_id = 1").collect()}
    assert last == {200, 201}


def test_previous_value_leaves_other_buckets_alone(spark, path):
    job = jobs.PreviousReading(spark, path, delay=60, hot=Hot(), buckets=8)
    job.process(batch(spark, *[(u, u, 60 + u, "2024-01-01T00:00:00") for u in range(40)]), 0)
    job.process(batch(spark, (100, 3, 99, "2024-01-01T01:00:00")), 1)  # settles all of the first batch
    before = files(path + "/state/last")
    assert len({os.path.dirname(f) for f in before}) == 8
    job.process(batch(spark, (101, 3, 98, "2024-01-01T02:00:00")), 2)
    after = files(path + "/state/last")
    assert {f: after[f] for f in before} == before  # still named by clocks that a restart may need
    new = set(after) - set(before)
    assert len({os.path.dirname(f) for f in new}) == 1 and all("batch=2" in f for f in new)
    for n in range(3, 7):
        job.process(batch(spark, (102 + n, 3, 90 + n, f"2024-01-01T{n:02d}:00:00")), n)
    left = files(path + "/state/last")
    assert sum("batch=1/" in f for f in left) == 7  # the silent users' buckets; the busy one's was forgotten
    job.finish(6)
    got = {r.event_id: r.previous_heart_rate for r in job.result().collect()}
    assert got[100] == 63 and got[101] == 99 and got[105] == 98 and got[7] is None and len(got) == 46


def test_messages_keep_their_place(spark):
    messages = spark.createDataFrame(
        [(bytearray(b'{"user_id": 1, "heart_rate": 70, "timestamp": 5}'), "heartrate", 3, 42), (bytearray(b"{oops"), "heartrate", 4, 43)],
        "value binary, topic string, partition int, offset long").withColumn("timestamp", F.timestamp_seconds(F.lit(9)))
    good, bad = raw.split_corrupt(raw.decode_events(messages, lineage=True))
    assert [(r.user_id, r._topic, r._partition, r._offset) for r in good.collect()] == [(1, "heartrate", 3, 42)]
    assert [(r._corrupt_record, r._partition, r._offset) for r in bad.collect()] == [("{oops", 4, 43)]


class Reader:
    """Records what a stream reader is asked for; no broker is opened."""

    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **more):
        self.asked.update(more)
        return self


@pytest.mark.parametrize("more", [{}, {"startingOffsets": "earliest", "failOnDataLoss": "false"}])
def test_topic_options(more):
    class Session:
        readStream = Reader()
    asked = raw.topic_reader(Session(), "host:9092", "heartrate-topic1", max_offsets=5, **more).asked
    assert asked == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "heartrate-topic1",
                     "maxOffsetsPerTrigger": 5, **more}


def test_loaded_files_go_to_the_archive(spark, path):
    def load(name, event):
        os.makedirs(path + "/in", exist_ok=True)
        with open(f"{path}/in/{name}.json", "w") as f:
            f.write(f'{{"event_id": {event}, "user_id": 1, "heart_rate": 70, "timestamp": 5, "meta": "x"}}\n')
        jobs.incremental_append(spark, path + "/in", path + "/t", path + "/cp", with_id=True, archive=path + "/done")

    for event, name in enumerate("abc"):
        load(name, event)
    archived = {n for _, _, names in os.walk(path + "/done") for n in names if n.endswith(".json")}
    assert {"a.json"} <= archived and archived.isdisjoint(n for n in os.listdir(path + "/in") if n.endswith(".json"))
    assert sorted(r.event_id for r in spark.read.parquet(path + "/t").collect()) == [0, 1, 2]
