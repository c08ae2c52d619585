import json
import os

from frames import meta, raw_activities, raw_users, seconds
from pulselake.__main__ import parser, run
from pulselake.registry import Lake


def land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        for user, rate, at in rows:  # as devices send them: without an event id
            f.write(json.dumps({"user_id": user, "heart_rate": rate, "timestamp": seconds(at),
                                "meta": json.loads(meta())}) + "\n")


def test_from_raw_files_to_gold_and_on(spark, path):
    raw_users(spark, [{}]).write.option("header", True).csv(path + "/users")
    raw_activities(spark).write.option("header", True).csv(path + "/activities")
    land(path + "/events/2024/01/01/00", "p0", [(10001, 70, "2024-01-01T00:00:00"), (10001, 72, "2024-01-01T00:00:02"),
                                                (None, 1, "2024-01-01T00:00:03")])
    lake = Lake(spark, path + "/lake")

    def cli(*words):
        run(lake, parser().parse_args([*words, "--root", lake.root]))

    def previous():
        return [(str(r.event_date), r.event_time, r.heart_rate, r.previous_heart_rate) for r in
                lake.read("gold", "fct_heart_rate").orderBy("event_date", "event_time").collect()]

    cli("ingest", "--users", path + "/users", "--activities", path + "/activities", "--events", path + "/events")
    cli("refresh")
    day_one = [("2024-01-01", "00:00:00", 70, None), ("2024-01-01", "00:00:02", 72, 70)]
    assert previous() == day_one

    # The next delivery repeats a known reading.
    land(path + "/events/2024/01/02/00", "p0", [(10001, 75, "2024-01-02T00:00:00"), (10001, 75, "2024-01-02T00:00:00")])
    cli("ingest", "--events", path + "/events")
    cli("ingest", "--events", path + "/events")
    cli("refresh", "--since", "2024-01-02")
    assert previous() == [*day_one, ("2024-01-02", "00:00:00", 75, 72)]
    assert lake.read("bronze", "heartrate_stream").count() == 5
    cli("refresh", "--since", "2024-01-02", "--arrived-since", "2024-01-02")
    assert previous() == [*day_one, ("2024-01-02", "00:00:00", 75, 72)]
    tomorrow = lake.read("bronze", "heartrate_stream", where="ingest_day > current_date()")
    assert tomorrow.count() == 0
