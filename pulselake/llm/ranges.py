"""Ordering a table across tasks: sampled splitters, ranges, and running totals.

The driver holds the splitters and one line of totals per range. Both are bounded by
the number of ranges asked for, not by the table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate
from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.text import partitions

RANGE, START, ROW = "__range", "__start", "__row"
SAMPLES_PER_RANGE = 40


def range_index(key: Sequence[Column], splitters: Sequence[Sequence[int]]) -> Column:
    """How many splitters are at or before the key: first among every m-th, then in between."""
    if not splitters:
        return F.lit(0)
    m = isqrt(len(splitters)) + 1

    def listed(part: Sequence[Sequence[int]]) -> Column:  # fields are named by their place
        return F.arrays_zip(*[F.lit(np.array(column, dtype=np.int64)) for column in zip(*part)])

    here = F.struct(*[k.cast("long").alias(str(i)) for i, k in enumerate(key)])
    coarse = (F.size(F.filter(listed(splitters[m - 1::m]), lambda s: s <= here)) * m
              if len(splitters) >= m else F.lit(0))
    return coarse + F.size(F.filter(F.slice(listed(splitters), coarse + 1, m - 1), lambda s: s <= here))


def sample_splitters(df: DataFrame, key: Sequence[str], weight: str, total: float, ranges: int) -> list[tuple]:
    """Weighted quantiles of a sample of keys.

    A row is drawn with probability proportional to its weight, by a hash of its key, so
    a retried task draws the same rows. About SAMPLES_PER_RANGE x ranges keys come back,
    whatever the size of the table.
    """
    if ranges < 2 or not total:
        return []
    step = total / (SAMPLES_PER_RANGE * ranges)
    draw = (F.xxhash64(F.lit("draw"), *key).bitwiseAND(F.lit((1 << 30) - 1))) / F.lit(float(1 << 30))
    rows = (df.filter(draw < F.col(weight) / F.lit(step))
            .select(*key, F.greatest(F.col(weight) / F.lit(step), F.lit(1.0)).alias("w")).collect())
    drawn = sorted((tuple(r[k] for k in key), r["w"]) for r in rows)
    ends = list(accumulate(w for _, w in drawn))
    cuts = {drawn[bisect_right(ends, ends[-1] * i / ranges)][0] for i in range(1, ranges)} if drawn else set()
    return sorted(cuts)


def _totals(df: DataFrame, key: Sequence[str], weight: str, splitters: Sequence[tuple]) -> dict[int, tuple]:
    rows = (df.select(range_index([F.col(k) for k in key], splitters).alias(RANGE), weight)
            .groupBy(RANGE).agg(F.sum(weight).alias("w"), F.count(F.lit(1)).alias("n")).collect())
    return {r[RANGE]: (r["w"], r["n"]) for r in rows}


def cut(df: DataFrame, key: Sequence[str], weight: str, ranges: int, rounds: int = 3) -> tuple[list[tuple], dict[int, tuple]]:
    """(splitters, weight and rows of each range that has any).

    There are ``ranges`` of them, or two for each shuffle partition if that is more.
    ``key`` are long columns without nulls. Ranges over twice their share are cut again by
    splitters drawn within them; a range of one single key stays.
    """
    ranges = max(ranges, 2 * partitions(df))  # so that they grow with the shuffle
    first = df.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()["w"]
    splitters = sample_splitters(df, key, weight, first, ranges)
    totals = _totals(df, key, weight, splitters)
    for _ in range(rounds):
        over = [r for r, (w, _) in totals.items() if w > 2 * first / ranges]
        if not over:
            break
        within = df.filter(range_index([F.col(k) for k in key], splitters).isin(over))
        weight_over = sum(totals[r][0] for r in over)
        more = sample_splitters(within, key, weight, weight_over, 2 * int(weight_over * ranges / first) + 2)
        finer = sorted({*splitters, *more})
        if finer == splitters:
            break
        splitters = finer
        totals = _totals(df, key, weight, splitters)
    return splitters, totals


def numbered(df: DataFrame, key: Sequence[str], weight: str, splitters: Sequence[tuple], totals: dict[int, tuple],
             order: Sequence[str] = ()) -> DataFrame:
    """The rows with __range, __start and __row, by what ``cut`` found.

    Rows are numbered in the order of the key (then ``order``); __start is the weight of all
    rows before.
    """
    known = sorted(totals)
    starts = dict(zip(known, accumulate([0, *(totals[r][0] for r in known)])))
    counts = dict(zip(known, accumulate([0, *(totals[r][1] for r in known)])))
    offsets = F.broadcast(df.sparkSession.createDataFrame(  # one row per range
        [(r, int(starts[r]), int(counts[r])) for r in known], f"{RANGE} int, __w0 long, __n0 long"))
    in_order = Window.partitionBy(RANGE).orderBy(*key, *order)
    before = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn(RANGE, range_index([F.col(k) for k in key], splitters))
            .repartition(RANGE)
            .withColumn("__w", F.sum(weight).over(before) - F.col(weight))
            .withColumn("__n", F.row_number().over(in_order) - 1)
            .join(offsets, RANGE)
            .withColumn(START, F.col("__w0") + F.col("__w"))
            .withColumn(ROW, F.col("__n0") + F.col("__n"))
            .drop("__w0", "__n0", "__w", "__n"))


def ranged(df: DataFrame, key: Sequence[str], weight: str, ranges: int, order: Sequence[str] = (),
           rounds: int = 3) -> tuple[DataFrame, int, int]:
    """(rows with __range, __start and __row; total weight; total rows). See ``cut`` and ``numbered``."""
    splitters, totals = cut(df, key, weight, ranges, rounds)
    out = numbered(df, key, weight, splitters, totals, order)
    return out, int(sum(w for w, _ in totals.values())), int(sum(n for _, n in totals.values()))
