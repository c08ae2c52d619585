"""Full and incremental refresh of all layers: written aside, checked, then published together."""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions.calendar import CATEGORY_NAMES
from pulselake.operators import quality as q
from pulselake.operators.keys import EVENT_KEY, changed_versions, dedup_events, dedup_latest
from pulselake.operators.skew import Hot
from pulselake.plans import dims, gold, silver
from pulselake.registry import Lake
from pulselake.session import side_by_side

DIMENSIONS = ["dim_users", "dim_activities", "dim_date", "dim_time"]
HISTORIES = ["dim_users_history", "dim_activities_history"]

# A reading outside these days is set aside: it would stretch the calendar.
EVENT_DAYS = (datetime.date(2000, 1, 1), datetime.date(2099, 12, 31))
# A delivery of users or activities of which more break a rule is refused as a whole.
REJECTED_SHARE = 0.1


def _event_day_in_bounds() -> q.Rule:
    low, high = EVENT_DAYS
    return q.Rule(f"event_day({low},{high})", ~F.to_date("event_timestamp").between(F.lit(low), F.lit(high)))


def silver_rules() -> dict[str, list[q.Rule]]:
    return {
        "dim_users": [*q.not_null("user_id"), q.castable("date_of_birth", "date"),
                      q.castable("start_date", "date")],
        "dim_activities": [*q.not_null("activity_id"), q.castable("start_date", "date"),
                           q.all_null("end_date")],
        "heart_rate_cleaned": [*q.not_null("user_id", "heart_rate"),
                               q.castable("event_timestamp", "timestamp"), _event_day_in_bounds(),
                               q.in_range("latitude", -90, 90), q.in_range("longitude", -180, 180)],
        "dim_date": q.not_null("date_day"),
        "dim_time": [*q.not_null("time_of_day"), q.accepted_values("time_category", CATEGORY_NAMES)],
        "dim_users_history": q.not_null("user_sk", "user_id", "start_date"),
        "dim_activities_history": q.not_null("activity_sk", "activity_id", "start_date"),
    }


def fact_rules() -> list[q.Rule]:
    return q.not_null("user_key", "heart_rate", "event_date", "event_time",
                      "max_heart_rate", "min_heart_rate", "avg_heart_rate")


@contextmanager
def cleaned_once(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` held while the block runs. Spark moves filters below the parsing, where each rule
    would parse the raw text again, for the good rows and once more for the others."""
    held = rows.persist()
    try:
        yield held
    finally:
        held.unpersist()


def split(rows: DataFrame, rules: list[q.Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with the names of those they break)."""
    flagged = q.flag(rows, rules)
    return (flagged.filter("NOT quarantined").drop("failed_rules", "quarantined"),
            flagged.filter("quarantined").drop("quarantined"))


def split_readings(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(readings, silver_rules()["heart_rate_cleaned"])


def _listed(days: list[datetime.date], column: str) -> str:
    return f"{column} IN ({', '.join(f"date'{d}'" for d in days)})" if days else "false"


def build_dimensions(lake: Lake) -> None:
    """Users and activities from bronze: the newest sound record of each, those set aside, and
    every version there has been, which the new records are merged into."""
    sources = [
        ("raw_users", "dim_users", "user_id", silver.users, silver.users_history),
        ("raw_activities", "dim_activities", "activity_id", silver.activities, silver.activities_history),
    ]
    with lake.transaction() as draft, ExitStack() as held:
        reports, writes = [], []
        for raw, key, id_column, clean, history in sources:
            records = held.enter_context(cleaned_once(clean(draft.read("bronze", raw), keep=("last_update",))))
            rules = silver_rules()[key]
            reports.append(q.report(records, key, rules))
            good, bad = split(records, rules)
            known = draft.read("silver", f"{key}_history", extra=("seen",)) if draft.has("silver", f"{key}_history") else None
            tables = {key: dedup_latest(good, id_column, "last_update").drop("last_update"),
                      f"{key}_rejected": bad.drop("last_update").distinct(), f"{key}_history": history(good, known)}
            writes += [partial(draft.write, df, "silver", name) for name, df in tables.items()]
        q.gate(reports, allowed=REJECTED_SHARE)
        side_by_side(*writes)


def build_calendar(lake: Lake, first_day: datetime.date = dims.FIRST_DAY, last_day: datetime.date = dims.LAST_DAY) -> None:
    """The days from ``first_day`` to ``last_day`` and the whole years of all other readings."""
    lake.write(dims.calendar_of(lake.read("silver", "last_readings"), "event_timestamp", first_day, last_day),
               "silver", "dim_date")


def _streamed(lake: Lake) -> DataFrame:
    """What streams have put beside the cleaned readings."""
    return lake.read_if_any("silver", "heart_rate_delta").withColumn("load", F.lit("stream"))


def build_silver(lake: Lake, first_day: datetime.date = dims.FIRST_DAY,
                 last_day: datetime.date = dims.LAST_DAY) -> None:
    raw = lake.read("bronze", "heartrate_stream", extra=("load",))
    with lake.transaction() as draft, cleaned_once(silver.heart_rate(raw, keep=("load",))) as held:
        good, bad = split_readings(held)
        good = good.drop("load").unionByName(_streamed(lake).drop("load"))

        def write_readings() -> None:  # one after the other: the second finds what the first has held
            draft.write(dedup_events(good), "silver", "heart_rate_cleaned")
            draft.write(dedup_events(bad, [*EVENT_KEY, "load"]), "silver", "heart_rate_rejected")

        side_by_side(partial(build_dimensions, draft), write_readings,
                     partial(draft.write, dims.dim_time(lake.spark), "silver", "dim_time"))
        draft.write(silver.last_readings(draft.read("silver", "heart_rate_cleaned")), "silver", "last_readings")
        build_calendar(draft, first_day, last_day)


def _scope(column: str, since: datetime.date | None, days: list[datetime.date] | None) -> str | None:
    if days is not None:
        return _listed(days, column)
    return f"{column} >= date'{since}'" if since else None


def check_silver(lake: Lake, since: datetime.date | None = None, days: list[datetime.date] | None = None) -> list:
    """Audit the written tables, of the readings only ``days`` or the days from ``since`` on;
    one job, one aggregate per table."""
    scopes = {"heart_rate_cleaned": _scope("event_day", since, days)}
    times = lake.read("silver", "dim_time")
    covered = q.coverage(times, "time_category", CATEGORY_NAMES)
    empty = covered.agg(F.count_if(F.col("rows") == 0).alias("violations"),
                        F.count(F.lit(1)).alias("total"))
    reports = [q.report(lake.read("silver", key, scopes.get(key)), key, rules) for key, rules in silver_rules().items()]
    reports.append(empty.select(F.lit("dim_time").alias("table"), F.lit("coverage(time_category)").alias("rule"),
                                "violations", "total"))
    return q.gate(reports)


def publish(lake: Lake, key: str, rules: list[q.Rule] | None = None) -> None:
    """Copy a dimension from silver to gold as it is, once its rules hold."""
    extra = lake.table("gold", key).extra.names
    df = lake.read("silver", key, extra=extra)
    rules = silver_rules()[key] if rules is None else rules
    if rules:
        q.gate([q.report(df, key, rules)])
    lake.write(df, "gold", key)


def check_gold(lake: Lake, since: datetime.date | None = None, days: list[datetime.date] | None = None) -> list:
    """Audit the fact, or ``days`` of it, or its days from ``since`` on. No reading is sorted: what is
    carried from day to day is told from the last readings."""
    fact = lake.read("gold", "fct_heart_rate", _scope("event_date", since, days))
    chains = q.broken_chains(fact, gold.user_days(lake.read("silver", "last_readings"), since, days))
    dates = (fact.select("event_date").distinct()
             .join(lake.read("silver", "dim_date").select(F.col("date_day").alias("event_date")), "event_date", "left_anti"))

    def as_report(df: DataFrame, rule: str, violations) -> DataFrame:
        return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
                      F.count(F.lit(1)).alias("total")).select(
            F.lit("fct_heart_rate").alias("table"), F.lit(rule).alias("rule"), "violations", "total")

    reports = [
        q.report(fact, "fct_heart_rate", fact_rules()),
        as_report(q.reconcile_groups(fact), "daily statistics agree", F.count_if(~F.col("matches"))),
        as_report(chains, "previous values continue", F.count(F.lit(1))),
        as_report(dates, "days are in the calendar", F.count(F.lit(1))),
    ]
    if since is None and days is None:
        reports.append(as_report(q.first_row_null(fact), "first reading has no previous", F.sum("violations")))
    return q.gate(reports)


def build_gold(lake: Lake, since: datetime.date | None = None, hot: Hot | None = None,
               days: list[datetime.date] | None = None) -> None:
    """The fact, or ``days`` of it, or just its days from ``since`` on.

    A reading's previous value depends on earlier readings only, so other days
    stand. What they contribute is each user's last reading, found in
    the small table of last readings instead of the history itself.
    """
    histories = {name: lake.read_if_any("silver", f"dim_{name}_history") for name in ("users", "activities")}
    fact = gold.fact_by_day(lake.read("silver", "heart_rate_cleaned", where=_scope("event_day", since, days)),
                            lake.read("silver", "last_readings"), since, hot, days, **histories)
    lake.write(fact, "gold", "fct_heart_rate", only_partitions=bool(since) or days is not None, laid_out=True)


def _write_gold(draft: Lake, days: list[datetime.date] | None = None) -> None:
    """The fact, if any of its days change, and the dimensions as they were checked in silver."""
    copies = [partial(publish, draft, key, rules=[]) for key in [*DIMENSIONS, *HISTORIES]]
    side_by_side(*([] if days == [] else [partial(build_gold, draft, days=days)]), *copies)


def full_refresh(lake: Lake, first_day: datetime.date = dims.FIRST_DAY,
                 last_day: datetime.date = dims.LAST_DAY) -> DataFrame:
    """Bronze to gold. All tables are written aside and published together once every check holds;
    a failing one raises, and silver and gold stay as they were."""
    taken = lake.delta_leaves("heart_rate_cleaned")
    with lake.transaction() as draft:
        build_silver(draft, first_day, last_day)
        check_silver(draft)
        _write_gold(draft)
        check_gold(draft)
    lake.drop_deltas("heart_rate_cleaned", taken)
    return lake.read("gold", "fct_heart_rate")


def merge_days(lake: Lake, fresh: DataFrame, load: str | None = None) -> tuple[list[datetime.date], list[datetime.date]]:
    """Merge new silver readings into their days, whichever those are; (those days, the days of
    which the fact changes).

    Only those days are read and rewritten and copies of known readings vanish. The fact
    changes on them and on the next day that one of their users has a reading of, since a previous
    value reaches just one reading ahead. Readings that break a rule go to the rejected table, under
    their ``load`` (a column of ``fresh``, or the one named here), and replace what stood there. The
    calendar bounds the lists of days.
    """
    if "load" not in fresh.columns:
        fresh = fresh.withColumn("load", F.lit(load or "merge"))
    with lake.transaction() as draft:
        with cleaned_once(fresh) as held:
            good, bad = split_readings(held)
            draft.write(dedup_events(bad, [*EVENT_KEY, "load"]), "silver", "heart_rate_rejected", only_partitions=True)
            good = good.drop("load")
            changed = good.select("user_id", F.to_date("event_timestamp").alias("day")).distinct()
            days = sorted(r["day"] for r in changed.select("day").distinct().collect())
            if not days:
                return [], []
            listed = _listed(days, "event_day")
            merged = dedup_events(draft.read_if_any("silver", "heart_rate_cleaned", where=listed).unionByName(good))
            draft.write(merged, "silver", "heart_rate_cleaned", only_partitions=True)
            touched = draft.read("silver", "heart_rate_cleaned", where=listed)
            draft.write(silver.last_readings(touched), "silver", "last_readings", only_partitions=True)
            following = _next_days(draft.read("silver", "last_readings"), changed)
            return days, sorted({*days, *following})


def compact(lake: Lake) -> list[datetime.date]:
    """Take what streams have brought into the cleaned readings' days; those days. Batches that land
    meanwhile stay beside them, and a run that breaks off can be repeated."""
    taken = lake.delta_leaves("heart_rate_cleaned")
    if not taken:
        return []
    days, _ = merge_days(lake, _streamed(lake))
    lake.drop_deltas("heart_rate_cleaned", taken)
    return days


def _next_days(last: DataFrame, changed: DataFrame) -> list[datetime.date]:
    """The next day with a reading of each user of a changed day; not more rows than days."""
    mine = last.join(changed.select("user_id").distinct(), "user_id", "left_semi").select(
        "user_id", F.to_date("event_timestamp").alias("day"))
    following = mine.withColumn("next", F.lead("day").over(Window.partitionBy("user_id").orderBy("day")))
    return [r["next"] for r in following.join(changed, ["user_id", "day"], "left_semi")
            .filter("next IS NOT NULL").select("next").distinct().collect()]


def merge_readings(lake: Lake, fresh: DataFrame, load: str | None = None) -> datetime.date | None:
    """``merge_days``; the first day merged into."""
    return min(merge_days(lake, fresh, load)[0], default=None)


def _restated_days(lake: Lake, last: DataFrame, old: dict[str, DataFrame]) -> list[datetime.date]:
    """The days with readings whose user or activity has another version now than it had."""
    days = last.select("user_id", F.to_date("event_timestamp").alias("day"))
    valid = ((F.col("from_day").isNull() | (F.col("day") >= F.col("from_day")))
             & (F.col("to_day").isNull() | (F.col("day") < F.col("to_day"))))
    found = set()
    users = changed_versions(old["users"], lake.read("silver", "dim_users_history"), "user_id", "user_sk")
    found |= {r["day"] for r in days.join(users, "user_id").filter(valid).select("day").distinct().collect()}
    activities = changed_versions(old["activities"], lake.read("silver", "dim_activities_history"), "activity_id", "activity_sk")
    spans = activities.select("from_day", "to_day").distinct()  # of dates, so the calendar bounds them
    each = days.select("day").distinct()
    found |= {r["day"] for r in each.join(F.broadcast(spans), valid, "left_semi").collect()}
    return sorted(found)


def incremental_refresh(lake: Lake, since: datetime.date | None = None,
                        arrived_since: datetime.date | None = None) -> datetime.date | None:
    """Bring silver and gold up to date with new bronze readings; the first day rebuilt.

    ``arrived_since`` takes the readings that arrived from that day on, whatever their
    event time, so a late one is not missed; ``since`` takes those dated that day or later,
    by file statistics. Rebuilt are the days of the readings taken, the next day with a reading of
    each of their users, and the days on which a user's or an activity's version is another
    one now; the checks read no other day. The dimensions are reloaded from bronze and their
    histories merged; what streams have brought is taken in. All is published together once the checks hold.
    """
    arrived = f"ingest_day >= date'{arrived_since}'" if arrived_since else None
    raw = lake.read("bronze", "heartrate_stream", where=arrived, extra=("load",))
    if since:
        raw = raw.filter(F.col("timestamp") >= int(datetime.datetime.combine(
            since, datetime.time(), datetime.timezone.utc).timestamp()))
    fresh = silver.heart_rate(raw, keep=("load",)).unionByName(_streamed(lake))
    taken = lake.delta_leaves("heart_rate_cleaned")
    with lake.transaction() as draft:
        old = {name: lake.read_if_any("silver", f"dim_{name}_history") for name in ("users", "activities")}
        build_dimensions(draft)
        merged, days = merge_days(draft, fresh)
        last = draft.read_if_any("silver", "last_readings")
        days = sorted({*days, *_restated_days(draft, last, old)})
        if merged:
            build_calendar(draft)
        check_silver(draft, days=merged)
        _write_gold(draft, days)
        if days:
            check_gold(draft, days=days)
    lake.drop_deltas("heart_rate_cleaned", taken)
    return min(days, default=None)
