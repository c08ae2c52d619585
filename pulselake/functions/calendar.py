"""Date and time-of-day attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last hour of each category, in order of the day.
TIME_CATEGORIES = [
    (5, "Early Morning"),
    (11, "Morning"),
    (17, "Afternoon"),
    (21, "Evening"),
    (23, "Night"),
]
CATEGORY_NAMES = [name for _, name in TIME_CATEGORIES]

# Northern meteorological seasons by month.
SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Autumn": [9, 10, 11],
}


def time_category(hour: Column) -> Column:
    last_name = TIME_CATEGORIES[-1][1]
    result = None
    for upper, name in TIME_CATEGORIES[:-1]:
        result = F.when(hour <= upper, name) if result is None else result.when(hour <= upper, name)
    return result.otherwise(last_name)


def season(date: Column) -> Column:
    names = list(SEASONS)
    result = None
    for name in names[:-1]:
        hit = F.month(date).isin(SEASONS[name])
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result.otherwise(names[-1])


def day_of_week(date: Column) -> Column:
    """Monday 1 to Sunday 7, independent of locale."""
    return F.weekday(date) + F.lit(1)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def minute_of_day(ts: Column) -> Column:
    """``HH:mm:00``: the key of the per-minute time dimension."""
    return F.date_format(ts, "HH:mm:00")
