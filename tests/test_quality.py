import pytest
from pyspark.sql import functions as F

from frames import meta, raw_activities, raw_events
from pulselake.functions import bands
from pulselake.operators import quality as q
from pulselake.plans import gold, silver


def as_dict(report):
    return {r.rule: (r.violations, r.total) for r in report.collect()}


def test_rules_in_one_pass(spark):
    df = spark.createDataFrame([
        (1, "2024-01-01", 90.0, -180.0, "A", None),
        (None, "nope", 90.1, -180.1, "Z", 5),
        (3, None, None, 180.0, None, None)],
        "id long, d string, lat double, lon double, code string, gone long")
    rules = [*q.not_null("id"), q.castable("d", "date"), q.in_range("lat", -90, 90),
             q.in_range("lon", -180, 180), q.accepted_values("code", ["A", "B"]), q.all_null("gone")]
    assert as_dict(q.report(df, "t", rules)) == {
        "not_null(id)": (1, 3), "castable(d,date)": (2, 3), "range(lat)": (1, 3), "range(lon)": (1, 3),
        "accepted(code)": (1, 3), "all_null(gone)": (1, 3)}


def test_an_empty_table_breaks_no_rule(spark):
    assert as_dict(q.report(spark.range(0), "t", q.not_null("id"))) == {"not_null(id)": (0, 0)}


def test_gate_names_what_is_broken(spark):
    good = q.report(spark.range(2), "fine", q.not_null("id"))
    bad = q.report(spark.createDataFrame([(None,)], "id long"), "users", q.not_null("id"))
    assert len(q.gate([good])) == 1
    with pytest.raises(q.QualityError, match=r"users\.not_null\(id\): 1 of 1"):
        q.gate([good, bad])


def test_quarantine_keeps_every_row(spark, path):
    df = spark.createDataFrame([(1, 50.0), (None, 95.0), (3, None)], "id long, lat double")
    q.quarantine(df, [*q.not_null("id"), q.in_range("lat", -90, 90)], path + "/q")
    back = spark.read.parquet(path + "/q")
    rows = {r.id: (str(r.quarantined).lower(), r.failed_rules) for r in back.collect()}
    assert rows == {1: ("false", []), None: ("true", ["not_null(id)", "range(lat)"]), 3: ("false", [])}
    q.quarantine(df.filter("id = 1"), q.not_null("id"), path + "/q")  # nothing of the first run is left
    assert spark.read.parquet(path + "/q").count() == 1


def test_coverage_lists_absent_values(spark):
    df = spark.createDataFrame([("Night",), ("Night",), ("Other",)], "c string")
    got = {r.value: r.rows for r in q.coverage(df, "c", ["Night", "Morning"]).collect()}
    assert got == {"Night": 2, "Morning": 0}


def fact(spark):
    return gold.fact_rows(silver.heart_rate(raw_events(spark, [
        (1, 1, 70, "2024-01-01T00:00:00", meta()), (2, 1, 90, "2024-01-01T00:00:00", meta()),
        (3, 1, 80, "2024-01-02T08:00:00", "{"), (4, 1, 60, "2024-01-02T09:00:00", "{"),
        (5, 2, 75, "2024-01-01T00:00:00", meta())])))


def test_a_sound_fact_passes_all_fact_checks(spark):
    df = fact(spark)
    assert all(r.matches for r in q.reconcile_groups(df).collect())
    assert q.mismatched_rows(df).count() == 0
    assert q.broken_previous(df).count() == 0
    assert {r.violations for r in q.first_row_null(df).collect()} == {0}


def test_altered_statistics_are_found_even_with_a_null_activity(spark):
    df = fact(spark).withColumn("avg_heart_rate", F.when(F.col("event_id") == 4, 1.0)
                                .otherwise(F.col("avg_heart_rate")))
    wrong = [r for r in q.reconcile_groups(df).collect() if not r.matches]
    assert [(r.user_key, r.activity_id, r.readings) for r in wrong] == [(1, None, 2)]
    assert [r.event_id for r in q.mismatched_rows(df).collect()] == [4]


def test_missing_statistics_are_found(spark):
    df = fact(spark).withColumn("min_heart_rate", F.when(F.col("event_id") != 1, F.col("min_heart_rate")))
    assert [r.readings for r in q.reconcile_groups(df).collect() if not r.matches] == [2]


def test_altered_previous_values_are_found(spark):
    df = fact(spark).withColumn("previous_heart_rate", F.when(F.col("event_id") == 3, 1)
                                .when(F.col("event_id") == 5, 9).otherwise(F.col("previous_heart_rate")))
    assert {r.event_id: r.expected for r in q.broken_previous(df).collect()} == {3: 90, 5: None}
    assert {r.user_key: r.violations for r in q.first_row_null(df).collect()} == {1: 0, 2: 2}


def test_bands_at_their_edges(spark):
    names = [("Sleep", 40, 80), ("Run", 130, 205), ("Walk", 70, 150)]
    rows = [(n, v) for n, lo, hi in names for v in (lo - 1, lo, hi, hi + 1)]
    df = spark.createDataFrame(rows, "name string, rate long")
    got = [r[0] for r in df.select(bands.in_band(F.col("rate"), F.col("name"))).collect()]
    assert got == [False, True, True, False] * 3
    assert df.select(bands.band(F.col("name"))).distinct().count() == 3


def test_activities_unknown_to_the_dimension_are_kept(spark):
    rows = gold.join_activities(fact(spark), silver.activities(raw_activities(spark, [(1, "Other")])))
    assert rows.count() == 5 and rows.filter("activity_name is not null").count() == 0
