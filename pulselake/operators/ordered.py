"""Previous reading and group statistics that stand a hot user.

A plain window over the user puts a user's whole history in one task. Users
without too many rows take exactly that plan: one shuffle on the user serves
every window. The rows of hot users are cut into time slices instead; each
slice looks up its predecessor inside the slice, and its first row takes the
last value of the slice before. Both ways give the same answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.operators.skew import Hot, hot_keys, join_back, split_by_keys

_SLICE = ["_hour", "_instant", "_part"]
_PARTS = 256  # pieces at most that one crowded instant is cut into
_SAMPLE, _DRAWS = 64, 1 << 20  # ties drawn for each piece, out of so many values of their hash
_FIRST = -2**62  # stands for a missing time or id, which sorts first


def _slices(rows: DataFrame, key: str, ts: str, tie: str, limit: int) -> DataFrame:
    """Add slice columns whose order agrees with (ts, tie) for each key.

    A slice is an hour. An hour with more than ``limit`` rows is cut by instant; event times are
    whole seconds, so at most 3600 of them. An instant that is itself above ``limit`` is cut at quantiles
    of its own ties, however these are distributed, into as many pieces as it is too large. There are
    at most rows/limit such hours and instants, so both lists may be broadcast.
    """
    rows = rows.withColumn("_hour", F.coalesce(F.floor(F.unix_seconds(ts) / F.lit(3600)), F.lit(_FIRST)))
    instant = F.coalesce(F.unix_micros(ts), F.lit(_FIRST))
    hours = (rows.groupBy(key, "_hour").agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > limit).select(key, "_hour", F.lit(True).alias("_dense")))
    rows = (rows.join(F.broadcast(hours), [key, "_hour"], "left")
            .withColumn("_instant", F.when(F.col("_dense"), instant).otherwise(F.lit(0))))
    pieces = F.least(F.ceil(F.col("_n") / limit) * 2, F.lit(_PARTS))
    crowded = (rows.filter("_dense").groupBy(key, "_hour", "_instant").agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") > limit).select(key, "_hour", "_instant", "_n", pieces.alias("_pieces")))
    # Quantiles of a sample of ties drawn by their hash: the plan has this twice, and both must agree.
    drawn = F.pmod(F.xxhash64(tie), F.lit(_DRAWS)) * F.col("_n") < F.col("_pieces") * F.lit(_SAMPLE * _DRAWS)
    every = F.greatest(F.floor(F.size("_all") / F.col("_pieces")), F.lit(1))
    cuts = (rows.filter("_dense").join(F.broadcast(crowded), [key, "_hour", "_instant"])
            .filter(F.col(tie).isNotNull() & drawn)
            .groupBy(key, "_hour", "_instant", "_pieces").agg(F.sort_array(F.collect_list(tie)).alias("_all"))
            .select(key, "_hour", "_instant", F.array_distinct(
                F.filter("_all", lambda x, i: (i > 0) & (i % every == 0))).alias("_cuts")))
    part = F.when(F.col(tie).isNull(), F.lit(_FIRST)).otherwise(F.size(F.filter("_cuts", lambda c: c <= F.col(tie))).cast("long"))
    return (rows.join(F.broadcast(cuts), [key, "_hour", "_instant"], "left")
            .withColumn("_part", F.when(F.col("_cuts").isNotNull(), part).otherwise(F.lit(0)))
            .drop("_dense", "_cuts"))


def _previous_whole(rows: DataFrame, key: str, ts: str, tie: str, value: str, out: str) -> DataFrame:
    return rows.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(ts, tie)))


def _previous_sliced(rows: DataFrame, key: str, ts: str, tie: str, value: str, out: str,
                     limit: int) -> DataFrame:
    rows = _slices(rows, key, ts, tie, limit)
    inside = Window.partitionBy(key, *_SLICE).orderBy(ts, tie)
    # One row per slice, combined map-side: the window below sees slices, not rows.
    last = (rows.groupBy(key, *_SLICE)
            .agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(ts, tie)).alias("_last")))
    carry = last.select(
        key, *_SLICE,
        F.lag(F.col("_last.v")).over(Window.partitionBy(key).orderBy(*_SLICE)).alias("_carry"))
    # The rows are partitioned by slice already, so the join moves only `carry`.
    return (rows.withColumns({"_inside": F.lag(value).over(inside),
                              "_number": F.row_number().over(inside)})
            .join(carry, [key, *_SLICE], "left")
            .withColumn(out, F.when(F.col("_number") == 1, F.col("_carry")).otherwise(F.col("_inside")))
            .drop("_inside", "_number", "_carry", *_SLICE))


def _stats_whole(rows: DataFrame, group: list[str], stats: dict[str, Column]) -> DataFrame:
    w = Window.partitionBy(*group)
    return rows.withColumns({name: c.over(w) for name, c in stats.items()})


def _stats_joined(rows: DataFrame, source: DataFrame, group: list[str],
                  stats: dict[str, Column]) -> DataFrame:
    """Aggregate ``source`` first, then join back: a hot group shrinks map-side,
    and the join is a broadcast if its measured size allows, else AQE splits it."""
    table = source.groupBy(*group).agg(*[c.alias(name) for name, c in stats.items()])
    return join_back(rows, table, group)


def _by_heat(rows: DataFrame, key: str, hot: Hot | None,
             whole: Callable[[DataFrame], DataFrame],
             sliced: Callable[[DataFrame, Hot], DataFrame]) -> DataFrame:
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return whole(rows)
    cold_rows, hot_rows = split_by_keys(rows, key, hot.keys)
    return whole(cold_rows).unionByName(sliced(hot_rows, hot))


def with_previous(rows: DataFrame, key: str, ts: str, tie: str, value: str, out: str,
                  hot: Hot | None = None) -> DataFrame:
    """Add ``out``: the key's value just before in (ts, tie) order, NULL on the
    key's first row."""
    return _by_heat(
        rows, key, hot,
        lambda part: _previous_whole(part, key, ts, tie, value, out),
        lambda part, h: _previous_sliced(part, key, ts, tie, value, out, h.limit))


def with_group_stats(rows: DataFrame, group: list[str], stats: dict[str, Column],
                     hot: Hot | None = None) -> DataFrame:
    """Add each aggregate in ``stats`` over its ``group``, whose first column
    is the one that may be hot."""
    return _by_heat(
        rows, group[0], hot,
        lambda part: _stats_whole(part, group, stats),
        lambda part, h: _stats_joined(part, part, group, stats))


def with_previous_and_stats(rows: DataFrame, ts: str, tie: str, value: str, out: str,
                            group: list[str], derived: dict[str, Column],
                            stats: dict[str, Column], hot: Hot | None = None) -> DataFrame:
    """Both of the above in one go, keyed by the first column of ``group``.

    Other users need a single shuffle for it, because a partitioning by key
    already gathers every finer group. ``derived`` are group columns computed
    from the row; they are added after that shuffle, which keeps it narrow.
    """
    key = group[0]

    def whole(part: DataFrame) -> DataFrame:
        part = _previous_whole(part, key, ts, tie, value, out).withColumns(derived)
        return _stats_whole(part, group, stats)

    def sliced(part: DataFrame, h: Hot) -> DataFrame:
        previous = _previous_sliced(part, key, ts, tie, value, out, h.limit).withColumns(derived)
        return _stats_joined(previous, part.withColumns(derived), group, stats)

    return _by_heat(rows, key, hot, whole, sliced)
