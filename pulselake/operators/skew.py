"""Finding keys that hold too many rows for one task, and taking them apart.

A hot key is one with more rows than a fair share of the shuffle. There can be
at most as many of those as shuffle partitions, so their list is small by
construction and may be held by the driver, put in a filter or broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this many rows a key fits a task whatever its share.
MIN_HOT_ROWS = 1_000_000

_TRACKED = 4096  # items per sketch
_IN_LIST = 1000  # longer key lists are joined instead of listed in the filter


@dataclass(frozen=True)
class Hot:
    """The hot keys and the row count above which a group counts as hot."""

    keys: list = field(default_factory=list)
    limit: int = MIN_HOT_ROWS

    def __bool__(self) -> bool:
        return bool(self.keys)


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS,
             share: float | None = None) -> Hot:
    """Keys with more than ``share`` of all rows and more than ``min_rows``.

    One pass over the key column into frequent-item sketches, merged map-side;
    no row is shuffled. The sketches track 16 times as many items as can be
    hot, so no hot key is missed. ``share`` defaults to one shuffle partition's
    worth of rows.
    """
    share = share or 1.0 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = int(16 / share) // _TRACKED + 1
    top = min(_TRACKED, int(1 / share) + 1)
    sketches = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"),
             F.expr(f"approx_top_k({key}, {top}, {_TRACKED})").alias("top"))
    )
    found = sketches.collect()  # one row per bucket, at most `top` items each
    limit = int(max(min_rows, share * sum(r["n"] for r in found)))
    return Hot(sorted(i["item"] for r in found for i in r["top"] if i["count"] > limit), limit)


def split_by_keys(df: DataFrame, key: str, keys: list) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not listed, rows whose key is listed)."""
    if len(keys) <= _IN_LIST:
        listed = F.coalesce(F.col(key).isin(keys), F.lit(False))
        return df.filter(~listed), df.filter(F.col(key).isin(keys))
    schema = f"{key} {df.schema[key].dataType.simpleString()}"
    table = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in keys], schema))
    return df.join(table, key, "left_anti"), df.join(table, key, "left_semi")


def left_join(fact: DataFrame, dim: DataFrame, key: str, hot: Hot | None = None) -> DataFrame:
    """Row-preserving join to a dimension unique on ``key``.

    Rows of hot keys meet their dimension rows by broadcast, at most one per
    hot key; all others take the join Spark picks from measured sizes.
    """
    if not hot:
        return fact.join(dim, key, "left")
    cold_rows, hot_rows = split_by_keys(fact, key, hot.keys)
    _, hot_dim = split_by_keys(dim, key, hot.keys)
    return (cold_rows.join(dim, key, "left")
            .unionByName(hot_rows.join(F.broadcast(hot_dim), key, "left")))


def checked_broadcast(dim: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``dim`` marked for broadcast if it has at most ``max_rows`` rows. Beyond
    that it is returned unmarked, for a shuffled join whose skew AQE splits.

    Without the mark a reading's few activity ids would each shuffle to one
    task whenever Spark cannot tell the dimension's size in advance."""
    counted = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if counted <= max_rows else dim


def renamed_keys(columns: list[str]) -> dict[str, str]:
    return {c: f"_key_{c}" for c in columns}


def join_back(rows: DataFrame, table: DataFrame, group: list[str]) -> DataFrame:
    """Left join of an aggregate of ``rows`` onto them; NULL keys match."""
    names = renamed_keys(group)
    table = table.withColumnsRenamed(names)
    on = [F.col(c).eqNullSafe(F.col(names[c])) for c in group]
    return rows.join(table, on, "left").drop(*names.values())
