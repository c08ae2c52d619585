"""Casting and parsing of raw fields. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulselake.schemas import META


def parse_yyyymmdd(value: Column) -> Column:
    """DATE from an integer such as 19840229; NULL when it is no calendar day."""
    text = value.cast("string")
    # Eight digits exactly: a shorter number must not be read as a short year.
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def as_date(value: Column) -> Column:
    """DATE from ISO text (date or instant); NULL when it does not parse."""
    return value.try_cast("date")


# Seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z. An epoch in milliseconds is beyond.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_to_timestamp(seconds: Column) -> Column:
    """TIMESTAMP of an epoch in seconds; NULL outside the calendar's years 1 to 9999."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def parse_meta(text: Column) -> Column:
    """The ``meta`` document; a malformed text gives a NULL in every field."""
    return F.from_json(text, META)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def event_id(columns: list[str]) -> Column:
    """The source's id or, where it gives none, one derived from the whole record.

    Copies of a record then share their id and differing records do not, so the
    id serves both as tie-breaker and, with user and second, as dedup key.
    """
    derived = F.xxhash64("user_id", "timestamp", "heart_rate", "meta")
    return F.coalesce(F.col("event_id").cast("bigint"), derived) if "event_id" in columns else derived
