import json
import os

from pyspark.sql import functions as F

from frames import meta, raw_events, raw_users
from pulselake import schemas
from pulselake.sources import raw

LINE = {"event_id": 1, "user_id": 10001, "heart_rate": 128, "timestamp": 1711943972,
        "meta": {"activity_id": 20890, "location": {"latitude": 37.416834, "longitude": -121.975002}}}


def test_csv_roundtrip_with_commas_and_quotes(spark, path):
    users = raw_users(spark, [{"address": '1 "Old" Road, Town'}, {"userid": 2, "fname": None}])
    users.write.option("header", True).option("escape", '"').csv(path + "/u")
    back = raw.read_csv(spark, path + "/u", schemas.RAW_USER)
    assert sorted(map(str, back.collect())) == sorted(map(str, users.collect()))


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_plain_hour_directories_are_read_at_any_depth(spark, path):
    write(f"{path}/2024/04/01/03/p0.json", [LINE])
    write(f"{path}/2024/04/01/04/p1.json", [{**LINE, "event_id": 2}])
    df = raw.read_jsonl(spark, path, with_id=True)
    rows = {r.event_id: r for r in df.collect()}
    assert set(rows) == {1, 2}
    assert json.loads(rows[1].meta) == LINE["meta"]


def test_records_that_do_not_fit_are_kept_apart(spark, path):
    write(f"{path}/a.json", [LINE, "{broken", {**LINE, "event_id": 3, "heart_rate": "fast"}])
    good, bad = raw.split_corrupt(raw.read_jsonl(spark, path, with_id=True))
    assert [r.event_id for r in good.collect()] == [1]
    kept = {r._corrupt_record: r.event_id for r in bad.collect()}
    assert len(kept) == 2 and kept["{broken"] is None and 3 in kept.values()


def test_only_files_after_the_cursor(spark, path):
    write(f"{path}/old.json", [LINE])
    write(f"{path}/new.json", [{**LINE, "event_id": 2}])
    os.utime(f"{path}/old.json", (1_600_000_000, 1_600_000_000))
    df = raw.with_lineage(raw.read_jsonl(spark, path, with_id=True, modified_after="2021-01-01T00:00:00"))
    row = df.collect()
    assert [r.event_id for r in row] == [2]
    assert row[0]._source_file.endswith("new.json") and row[0]._source_modified is not None


def test_events_survive_encoding(spark):
    events = raw_events(spark, [(1, 10001, 128, "2024-04-01T03:59:32", meta()),
                                (2, 10002, None, "2024-04-01T03:59:33", None)])
    messages = raw.encode_events(events)
    first = messages.filter("key = '10001'").first()
    assert json.loads(first.value) == {"event_id": 1, "user_id": 10001, "heart_rate": 128,
                                       "timestamp": 1711943972, "meta": json.loads(meta())}
    back = raw.decode_events(messages.select(F.encode("value", "UTF-8").alias("value")), with_id=True)
    got = {r.event_id: (r.user_id, r.heart_rate, r._corrupt_record) for r in back.collect()}
    assert got == {1: (10001, 128, None), 2: (10002, None, None)}


def test_lake_directories_by_event_hour(spark, path):
    raw.write_lake(raw_events(spark, [(1, 1, 70, "2024-01-05T07:59:59", meta()),
                                      (2, 1, 71, "2024-01-05T08:00:00", meta())]), path + "/lake")
    assert os.path.isdir(f"{path}/lake/year=2024/month=01/day=05/hour=07")
    one = spark.read.json(path + "/lake").filter("hour = 8")
    assert [r.event_id for r in one.collect()] == [2]
    assert raw.read_jsonl(spark, path + "/lake", with_id=True).count() == 2


def test_topic_reader_asks_for_the_topic(spark):
    reader = raw.topic_reader(spark, "host:9092", "readings", 500, startingOffsets="earliest")
    assert type(reader).__name__ == "DataStreamReader"
