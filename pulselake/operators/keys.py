"""Duplicates, surrogate keys and type-2 history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT_KEY = ["user_id", "event_timestamp", "event_id"]


def dedup_events(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per event. Copies collapse map-side, so a group of any size is
    down to one row per task before the shuffle.

    Of copies that differ one whole record stays, the least by its columns in order
    with NULL after any value: it does not depend on arrival order or on which
    task ran again, and it is a record that was sent.
    """
    key = key or EVENT_KEY
    rest = [c for c in df.columns if c not in key]
    ranked = [x for c in rest for x in (F.col(c).isNull().alias(f"_{c}_null"), F.col(c))]
    if not rest:
        return df.select(*key).distinct()
    return df.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("_kept")).select(
        *[F.col(c) if c in key else F.col(f"_kept.{c}") for c in df.columns])


def conflicting_events(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key, versions) of the events whose copies differ."""
    key = key or EVENT_KEY
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key, *rest).agg(F.lit(1).alias("_one")).groupBy(*key)
            .agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1"))


def dedup_latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The newest record of each key, by an aggregate rather than a ranking so
    that a key with many versions shrinks before the shuffle.

    Records that tie on ``order`` are settled by their remaining columns.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_best"))
    return best.select(key, "_best.*").select(*df.columns)


def surrogate_key(*columns: str, algorithm: str = "xxhash64") -> Column:
    """A key that depends on the natural key and validity start alone, hence is
    the same in every run. ``md5`` gives a portable text key."""
    if algorithm == "xxhash64":
        return F.xxhash64(*columns)
    if algorithm == "md5":
        return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    raise ValueError(f"unknown algorithm {algorithm}")


def scd2_history(snapshots: DataFrame, key: str, order: list[str], effective: str,
                 attributes: list[str], seen: str | None = None) -> DataFrame:
    """Type-2 versions from repeated snapshots of a dimension.

    ``effective`` is the DATE a snapshot took effect and ``order`` ranks the
    snapshots of one day, of which the last counts (of equal rank the one of greatest
    attributes). A version starts when an attribute differs from the version before and
    ends on the next one's start; the active version has a NULL end. ``seen`` names a column for
    the snapshots that showed the version, each its day and rank, which ``scd2_merge`` needs to be exact.
    """
    # Down to one row per key and day first: the windows below then hold a
    # key's days, a number the calendar bounds.
    daily = (snapshots.groupBy(key, effective)
             .agg(F.max(F.struct(F.struct(*order).alias("rank"), F.struct(*attributes).alias("now"))).alias("_last"))
             .select(key, effective, F.col("_last.now").alias("_now"), F.col("_last.rank").alias("_rank")))
    w = Window.partitionBy(key).orderBy(effective)
    marked = daily.withColumn("_was", F.lag("_now").over(w)).withColumn("_new", ~F.col("_now").eqNullSafe(F.col("_was")))
    if not seen:
        changed = marked.filter("_new")
        return changed.select(key, "_now.*", F.col(effective).alias("start_date"), F.lead(effective).over(w).alias("end_date"))
    numbered = marked.withColumn("_version", F.count_if("_new").over(w))
    versions = numbered.groupBy(key, "_version").agg(
        F.min(effective).alias("start_date"), F.min("_now").alias("_now"),
        F.sort_array(F.collect_list(F.struct(F.col(effective).alias("day"), "_rank.*"))).alias(seen))
    later = Window.partitionBy(key).orderBy("start_date")
    return versions.select(key, "_now.*", "start_date", F.lead("start_date").over(later).alias("end_date"), seen)


def scd2_merge(history: DataFrame, snapshots: DataFrame, key: str, order: list[str],
               effective: str, attributes: list[str], seen: str | None = None) -> DataFrame:
    """``history`` (as ``scd2_history`` returns it) brought up to date; keys without a new
    snapshot keep their versions as they are.

    With ``seen`` the result is the history of all snapshots together, however late one
    arrives: it cuts a version in two where that version was seen again afterwards. Without,
    every version counts as one snapshot taken when it started, ranked before the new ones of that
    day, which is right only for snapshots that arrive in order.
    """
    touched = snapshots.select(key).distinct()
    mine, rest = history.join(touched, key, "left_semi"), history.join(touched, key, "left_anti")
    if seen:
        known = mine.select(key, *attributes, F.explode(seen).alias("_s")).select(
            key, *attributes, F.col("_s.day").alias(effective), *[F.col(f"_s.{c}") for c in order])
        together = known.unionByName(snapshots.select(*known.columns))
        return scd2_history(together, key, order, effective, attributes, seen).unionByName(rest)
    first = [F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in order]
    known = mine.select(key, *attributes, F.col("start_date").alias(effective), *first, F.lit(0).alias("_new_snapshot"))
    fresh = snapshots.select(*known.columns[:-1], F.lit(1).alias("_new_snapshot"))
    merged = scd2_history(known.unionByName(fresh), key, ["_new_snapshot", *order], effective, attributes)
    return merged.unionByName(rest)


def changed_versions(old: DataFrame, new: DataFrame, key: str, sk: str) -> DataFrame:
    """(key, from_day, to_day): the days on which a record's version is another one now; an open end is NULL,
    and so is the start of a first version, which stands for the days before it as well."""
    def spans(history: DataFrame) -> DataFrame:
        before = F.lag("start_date").over(Window.partitionBy(key).orderBy("start_date"))
        return history.select(key, sk, F.when(before.isNotNull(), F.col("start_date")).alias("from_day"),
                              F.col("end_date").alias("to_day"))

    was, now = spans(old), spans(new)
    return now.exceptAll(was).unionByName(was.exceptAll(now)).select(key, "from_day", "to_day")


def versions_by_key(history: DataFrame, key: str, sk: str) -> DataFrame:
    """(key, versions): the starts and keys of each record's versions in one row, in order."""
    return history.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start_date", F.col(sk).alias("sk")))).alias("versions"))


def version_on(day: Column, versions: Column) -> Column:
    """The key of the version valid on a day; before the first one that one's."""
    until = F.filter(versions, lambda v: v["start_date"] <= day)
    return F.coalesce(F.try_element_at(until, F.lit(-1))["sk"], F.try_element_at(versions, F.lit(1))["sk"])
