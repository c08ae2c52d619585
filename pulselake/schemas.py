"""Column names and types of every table, by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "snapshots": T.ArrayType(T.StructType([T.StructField("day", T.DateType()), T.StructField("last_update", T.StringType())])),
}


def _struct(columns: str) -> T.StructType:
    """A schema from "name type, ..." (StructType.fromDDL needs a live session)."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


META = T.StructType([
    T.StructField("activity_id", T.LongType()),
    T.StructField("location", _struct("latitude double, longitude double")),
])

RAW_USER = _struct(
    "userid bigint, fname string, lname string, dob bigint, sex string, height bigint,"
    " weight bigint, blood_type string, race string, origin_country_code string,"
    " origin_country_name string, address string, address_country_code string,"
    " address_country_name string, last_update string"
)
RAW_ACTIVITY = _struct("activity_id bigint, activity_name string, last_update string")
RAW_HEART_RATE = _struct("user_id bigint, heart_rate bigint, timestamp bigint, meta string")
# event_id is optional in raw data; see functions.clean.event_id.
RAW_HEART_RATE_WITH_ID = T.StructType([*_struct("event_id bigint").fields, *RAW_HEART_RATE.fields])

DIM_USERS = _struct(
    "user_id bigint, first_name string, last_name string, date_of_birth date, gender string,"
    " height bigint, weight bigint, blood_type string, race string, origin_country string,"
    " address string, address_country string, start_date date, end_date date"
)
DIM_ACTIVITIES = _struct("activity_id bigint, activity_name string, start_date date, end_date date")
# One row for each version of a record, valid from start_date until before end_date.
USERS_HISTORY = T.StructType([*_struct("user_sk bigint").fields, *DIM_USERS.fields])
ACTIVITIES_HISTORY = T.StructType([*_struct("activity_sk bigint").fields, *DIM_ACTIVITIES.fields])
SEEN = _struct("seen snapshots")
USERS_REJECTED = T.StructType([*DIM_USERS.fields, *_struct("failed_rules array<string>").fields])
ACTIVITIES_REJECTED = T.StructType([*DIM_ACTIVITIES.fields, *_struct("failed_rules array<string>").fields])
# The six documented columns plus event_id, which breaks ties within a second.
HEART_RATE_CLEANED = _struct(
    "user_id bigint, heart_rate bigint, event_timestamp timestamp, activity_id bigint,"
    " latitude double, longitude double, event_id bigint"
)
HEART_RATE_REJECTED = _struct(
    "user_id bigint, heart_rate bigint, event_timestamp timestamp, activity_id bigint,"
    " latitude double, longitude double, event_id bigint, failed_rules array<string>"
)
LAST_READINGS = _struct("user_id bigint, event_timestamp timestamp, event_id bigint, heart_rate bigint")
DIM_DATE = _struct(
    "date_day date, date date, prior_date_day date, next_date_day date,"
    " prior_year_date_day date, prior_year_over_year_date_day date, year_start_date date,"
    " year_end_date date, day int, day_of_week int, day_name string, is_weekend boolean"
)
MONTH_END = _struct("month_end_date date")
DIM_TIME = _struct("time_of_day string, hour int, minute int, second int, time_category string")
FCT_HEART_RATE = _struct(
    "user_key bigint, heart_rate bigint, event_date date, event_time string,"
    " previous_heart_rate bigint, max_heart_rate bigint, min_heart_rate bigint,"
    " avg_heart_rate double, activity_id bigint, latitude double, longitude double"
)
# Keys of the versions of user and activity that are valid on the day of the reading.
VERSION_KEYS = _struct("user_sk bigint, activity_sk bigint")


class SchemaMismatch(ValueError):
    """A frame does not have the columns its table declares."""


def check_contract(df: DataFrame, expected: T.StructType, name: str = "table") -> DataFrame:
    """``df`` with its columns in declared order, or SchemaMismatch.

    Metadata only: no job runs.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    if actual != wanted or len(df.columns) != len(expected.fields):
        missing = sorted(set(wanted.items()) - set(actual.items()))
        extra = sorted(set(actual.items()) - set(wanted.items()))
        raise SchemaMismatch(f"{name}: missing {missing}, unexpected {extra}")
    return df.select(*[f.name for f in expected.fields])
