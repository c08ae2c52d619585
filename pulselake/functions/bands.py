"""Plausible heart rates by kind of activity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Activity names per band and the band's limits, both inclusive.
REST = ["Stand", "Sit", "Sleep"]
VIGOROUS = ["Run", "HIIT", "Swimming", "Kickboxing", "Multisport"]
LIMITS = {"rest": (40, 80), "vigorous": (130, 205), "other": (70, 150)}


def band(activity_name: Column) -> Column:
    return (F.when(activity_name.isin(REST), "rest")
            .when(activity_name.isin(VIGOROUS), "vigorous")
            .otherwise("other"))


def _limit(activity_name: Column, side: int) -> Column:
    return (F.when(activity_name.isin(REST), LIMITS["rest"][side])
            .when(activity_name.isin(VIGOROUS), LIMITS["vigorous"][side])
            .otherwise(LIMITS["other"][side]))


def in_band(heart_rate: Column, activity_name: Column) -> Column:
    return heart_rate.between(_limit(activity_name, 0), _limit(activity_name, 1))
