"""Raw to silver: rename, cast, flatten, filter, deduplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake import schemas
from pulselake.functions.clean import (
    as_date, epoch_to_timestamp, event_id, parse_meta, parse_yyyymmdd, typed_null)
from pulselake.operators.keys import dedup_events, dedup_latest, scd2_history, scd2_merge, surrogate_key


def users(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One open-ended record per row with an id, with the raw columns in ``keep``."""
    return raw.filter(F.col("userid").isNotNull()).select(
        F.col("userid").alias("user_id"),
        F.col("fname").alias("first_name"),
        F.col("lname").alias("last_name"),
        parse_yyyymmdd(F.col("dob")).alias("date_of_birth"),
        F.col("sex").alias("gender"),
        "height", "weight", "blood_type", "race",
        F.col("origin_country_name").alias("origin_country"),
        "address",
        F.col("address_country_name").alias("address_country"),
        as_date(F.col("last_update")).alias("start_date"),
        typed_null("date").alias("end_date"), *keep)


def activities(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return raw.filter(F.col("activity_id").isNotNull()).select(
        "activity_id", "activity_name",
        as_date(F.col("last_update")).alias("start_date"),
        typed_null("date").alias("end_date"), *keep)


def heart_rate(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat readings from a raw batch or stream, with the raw columns in ``keep``; no shuffle."""
    return (raw.filter(F.col("user_id").isNotNull())
            .select("user_id", "heart_rate", epoch_to_timestamp(F.col("timestamp")).alias("event_timestamp"),
                    parse_meta(F.col("meta")).alias("m"), event_id(raw.columns).alias("event_id"), *keep)
            .select("user_id", "heart_rate", "event_timestamp",
                    F.col("m.activity_id").alias("activity_id"),
                    F.col("m.location.latitude").alias("latitude"),
                    F.col("m.location.longitude").alias("longitude"),
                    "event_id", *keep))


def latest_users(raw: DataFrame) -> DataFrame:
    """The users dimension: newest record of each user."""
    return users(dedup_latest(raw.filter(F.col("userid").isNotNull()), "userid", "last_update"))


def latest_activities(raw: DataFrame) -> DataFrame:
    return activities(dedup_latest(raw.filter(F.col("activity_id").isNotNull()), "activity_id", "last_update"))


USER_ATTRIBUTES = [c for c in schemas.DIM_USERS.names if c not in ("user_id", "start_date", "end_date")]
ACTIVITY_ATTRIBUTES = ["activity_name"]
_RANK = ["last_update"]  # of the snapshots of one day


def _snapshots(records: DataFrame) -> DataFrame:
    """Records as snapshots; one whose update has no day can't take effect."""
    return records.filter("start_date IS NOT NULL")


def user_snapshots(raw: DataFrame) -> DataFrame:
    return _snapshots(users(raw, keep=("last_update",)))


def activity_snapshots(raw: DataFrame) -> DataFrame:
    return _snapshots(activities(raw, keep=("last_update",)))


def _keyed(history: DataFrame, key: str, sk: str) -> DataFrame:
    return history.select(surrogate_key(key, "start_date").alias(sk), "*")


def users_history(snapshots: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every version of every user with its surrogate key; ``known`` is the history so far."""
    return _history(snapshots, known, "user_id", "user_sk", USER_ATTRIBUTES)


def activities_history(snapshots: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _history(snapshots, known, "activity_id", "activity_sk", ACTIVITY_ATTRIBUTES)


def _history(snapshots: DataFrame, known: DataFrame | None, key: str, sk: str, attributes: list[str]) -> DataFrame:
    how = (key, _RANK, "day", attributes, "seen")
    taken = snapshots.select(key, *attributes, F.col("start_date").alias("day"), *_RANK)
    if known is None:
        return _keyed(scd2_history(taken, *how), key, sk)
    return _keyed(scd2_merge(known.drop(sk), taken, *how), key, sk)


def distinct_heart_rate(raw: DataFrame) -> DataFrame:
    return dedup_events(heart_rate(raw))


def unparsed_dates(raw: DataFrame) -> DataFrame:
    """Users whose date of birth is given but is no calendar day."""
    return raw.filter(F.col("userid").isNotNull() & F.col("dob").isNotNull()
                      & parse_yyyymmdd(F.col("dob")).isNull())


def last_readings(hr: DataFrame) -> DataFrame:
    """Each user's last reading of each day, combined map-side."""
    day = F.to_date("event_timestamp").alias("event_day")
    last = F.max(F.struct("event_timestamp", "event_id", "heart_rate")).alias("r")
    return hr.groupBy("user_id", day).agg(last).select("user_id", "r.*")
