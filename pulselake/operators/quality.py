"""Data-quality rules, evaluated in one pass per table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.operators.ordered import with_previous
from pulselake.operators.skew import Hot, join_back

@dataclass(frozen=True)
class Rule:
    """``violated`` is true on a row that breaks the rule; NULL counts as kept."""

    name: str
    violated: Column


class QualityError(RuntimeError):
    """A load was blocked because a rule is violated."""


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"not_null({c})", F.col(c).isNull()) for c in columns]


def castable(column: str, type_name: str) -> Rule:
    """Every row casts; a missing value counts as a violation."""
    return Rule(f"castable({column},{type_name})", F.col(column).try_cast(type_name).isNull())


def all_null(column: str) -> Rule:
    return Rule(f"all_null({column})", F.col(column).isNotNull())


def in_range(column: str, low: float, high: float) -> Rule:
    return Rule(f"range({column})", ~F.col(column).between(low, high))


def accepted_values(column: str, values: Iterable) -> Rule:
    return Rule(f"accepted({column})", ~F.col(column).isin(list(values)))


def report(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """(table, rule, violations, total), all rules in one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(r.violated).alias(f"r{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations"))
                      for i, r in enumerate(rules)])
    return (counts.select("total", F.explode(pairs).alias("p"))
            .select(F.lit(table).alias("table"), "p.rule", "p.violations", "total"))


def gate(reports: list[DataFrame], allowed: float = 0.0) -> list:
    """Run the reports; QualityError names every rule that more than the ``allowed`` share of rows violates."""
    rows = reduce(DataFrame.unionByName, reports).collect()  # one row per rule
    broken = [f"{r['table']}.{r['rule']}: {r['violations']} of {r['total']}"
              for r in rows if r["violations"] > allowed * r["total"]]
    if broken:
        raise QualityError("; ".join(broken))
    return rows


def flag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``failed_rules`` (names) and ``quarantined``."""
    violated = [F.coalesce(r.violated, F.lit(False)) for r in rules]
    failed = F.array_compact(F.array(*[F.when(v, F.lit(r.name)) for r, v in zip(rules, violated)]))
    # Not read from the array: a filter on it would build the array for every row.
    return df.withColumns({"failed_rules": failed, "quarantined": reduce(lambda a, b: a | b, violated, F.lit(False))})


def quarantine(df: DataFrame, rules: list[Rule], path: str) -> None:
    """One pass that writes kept and failing rows to sibling directories
    ``quarantined=false`` and ``quarantined=true``."""
    (flag(df, rules).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("quarantined").parquet(path))


def coverage(df: DataFrame, column: str, expected: list) -> DataFrame:
    """(value, rows) for every expected value, zero where the table has none."""
    spark = df.sparkSession
    seen = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    wanted = spark.createDataFrame([(v,) for v in expected], "value string")
    return wanted.join(seen, "value", "left").select("value", F.coalesce("rows", F.lit(0)).alias("rows"))


# Checks on the fact table -----------------------------------------------------

def reconcile_groups(fact: DataFrame) -> DataFrame:
    """Per user, activity and day: do all rows carry the group's statistics?

    The carried values' extremes are compared with the group's own aggregate,
    so one aggregation decides it; no row is joined back.
    """
    stats = {"max_heart_rate": F.max("heart_rate"), "min_heart_rate": F.min("heart_rate"),
             "avg_heart_rate": F.avg("heart_rate")}
    checks = [F.count(F.lit(1)).alias("readings")]
    for name, expected in stats.items():
        checks += [expected.alias(f"_{name}"), F.min(name).alias(f"_lo_{name}"),
                   F.max(name).alias(f"_hi_{name}"), F.count(name).alias(f"_n_{name}")]
    grouped = fact.groupBy("user_key", "activity_id", "event_date").agg(*checks)

    def agrees(name: str) -> Column:
        own = F.col(f"_{name}")
        carried = F.col(f"_n_{name}")
        return F.when(own.isNull(), carried == 0).otherwise(
            (carried == F.col("readings")) & (F.col(f"_lo_{name}") == own) & (F.col(f"_hi_{name}") == own))

    matches = reduce(lambda a, b: a & b, [agrees(name) for name in stats])
    return grouped.select("user_key", "activity_id", "event_date", "readings", matches.alias("matches"))


def mismatched_rows(fact: DataFrame) -> DataFrame:
    """The readings whose statistics differ from their group's, beside the
    expected ones. The group's aggregate is joined back, NULL activity included."""
    group = ["user_key", "activity_id", "event_date"]
    expected = fact.groupBy(*group).agg(
        F.max("heart_rate").alias("expected_max"), F.min("heart_rate").alias("expected_min"),
        F.avg("heart_rate").alias("expected_avg"))
    same = (F.col("max_heart_rate").eqNullSafe(F.col("expected_max"))
            & F.col("min_heart_rate").eqNullSafe(F.col("expected_min"))
            & F.col("avg_heart_rate").eqNullSafe(F.col("expected_avg")))
    return join_back(fact, expected, group).filter(~same)


def broken_previous(rows: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Readings whose previous value is not the value before them, for all users
    at once; ``rows`` carry event_timestamp and event_id."""
    checked = with_previous(rows, "user_key", "event_timestamp", "event_id", "heart_rate", "expected", hot)
    return checked.filter(~F.col("previous_heart_rate").eqNullSafe(F.col("expected")))


def broken_chains(fact: DataFrame, days: DataFrame) -> DataFrame:
    """(user_key, event_date) whose previous values are not those of the readings before, without ordering any.

    ``days`` has for each user and day in ``fact`` the last value and the last reading of the
    user's day before (``gold.user_days``). Within a day the previous values are the day's own but the last
    one, and the one carried in. So sums of their hashes agree, and sums combine map-side.
    Values that trade places within a day are left to ``broken_previous``.
    """
    def weight(value: Column) -> Column:  # 31 bits: the sum of four billion rows fits
        return F.pmod(F.xxhash64(value), F.lit(1 << 31))

    sums = fact.groupBy("user_key", "event_date").agg(
        F.sum(weight(F.col("previous_heart_rate"))).alias("_previous"), F.sum(weight(F.col("heart_rate"))).alias("_own"))
    ends = days.select(
        F.col("user_key").alias("_user"), F.col("event_date").alias("_day"),
        (weight(F.col("last_heart_rate")) - weight(F.col("before.heart_rate"))).alias("_shift"))
    both = sums.join(ends, F.col("user_key").eqNullSafe(F.col("_user")) & F.col("event_date").eqNullSafe(F.col("_day")), "full")
    sound = F.coalesce(F.col("_own") - F.col("_previous") == F.col("_shift"), F.lit(False))
    return both.filter(~sound).select(F.coalesce("user_key", "_user").alias("user_key"),
                                      F.coalesce("event_date", "_day").alias("event_date"))


def first_row_null(fact: DataFrame) -> DataFrame:
    """Per user: exactly the first reading has no previous one.

    ``violations`` counts readings that wrongly have or lack one. Within the
    first second any single reading may be the first.
    """
    moment = F.struct("event_date", "event_time")
    missing = F.col("previous_heart_rate").isNull()
    return (fact.groupBy("user_key")
            .agg(F.count_if(missing).alias("_missing"), F.min(moment).alias("_first"),
                 F.min(F.when(missing, moment)).alias("_first_missing"))
            .select("user_key",
                    (F.abs(F.col("_missing") - 1)
                     + F.when(F.col("_first").eqNullSafe(F.col("_first_missing")), 0).otherwise(1)
                     ).alias("violations")))
