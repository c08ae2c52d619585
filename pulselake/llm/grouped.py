"""Groups of a sorted stream of Arrow batches, and pairs of blocks of large groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Rows with equal ``by`` (integer columns without nulls) of a stream sorted by them."""
    held, last = [], None
    for rows in batches:
        if not len(rows):
            continue
        keys = np.stack([np.asarray(rows.column(b)).astype(np.int64) for b in by], 1)
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and tuple(keys[a]) != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(rows.slice(a, b - a))
            last = tuple(keys[a])
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def dealt(members: DataFrame, key: list[str], size: int, weight: str | None = None, load: int = 1) -> DataFrame:
    """``members`` dealt to (key, x, y): blocks of about ``size`` rows of a key, two by two.

    side is 0 where a block meets itself, else 1 or 2. A key of up to ``size`` rows is one
    group; of larger ones each row goes along once for each block, so no group is large.
    With a ``weight`` a block's rows sum up to about ``load`` of it at the most.
    """
    parts = F.ceil(F.count(F.lit(1)) / size)
    if weight:
        parts = F.greatest(parts, F.ceil(F.sum(weight) / load))
    crowd = members.groupBy(*key).agg(parts.cast("int").alias("__blocks"))
    columns = [c for c in members.columns if c not in key]
    return (members.join(crowd, key)
            .withColumn("__mine", F.pmod(F.xxhash64("node"), "__blocks").cast("int"))
            .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
            .select(*key, F.least("__mine", "__other").alias("x"), F.greatest("__mine", "__other").alias("y"),
                    F.when(F.col("__mine") == F.col("__other"), 0).when(F.col("__mine") < F.col("__other"), 1)
                    .otherwise(2).alias("side"), *columns))


def met(rows: DataFrame, key: list[str]) -> DataFrame:
    """Dealt rows, each group's beside one another in one task."""
    return rows.repartition(*key, "x", "y").sortWithinPartitions(*key, "x", "y")


def block_pairs(members: DataFrame, key: list[str], size: int) -> DataFrame:
    """``members`` dealt and met."""
    return met(dealt(members, key, size), key)
