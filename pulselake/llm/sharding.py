"""Shards of near equal size, by sampled splitters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.ranges import RANGE, ROW, START, ranged
from pulselake.llm.text import NULL_ID

KEY = ["__h", "__id"]


def shard(docs: DataFrame, shards: int = 24, ranges_per_shard: int = 16, whole_group: float = 0.005) -> DataFrame:
    """Every row of ``docs`` with size, text_crc32, law, shard, slot and grown_shard.

    Records are range-partitioned by (hash of the text, doc_id): size-weighted samples of
    the keys give the range boundaries, overfull ranges are subdivided, and running sizes
    within the ranges place the cuts between shards, so shard sizes differ by a few
    documents. Equal texts lie next to each other; a group of them of at most
    ``whole_group`` of a shard is never cut, a larger one may go on in the next shard.

    size is the UTF-8 length plus 8. slot counts from 0 within a shard. law is 'bytes',
    grown_shard therefore null. Null text: size 8, crc null. Null doc_id orders first.
    Repeated rows each get a slot of their own. An empty table gives no rows. Columns
    of the input that have one of the new names give way to the new ones.
    """
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    base = docs.select(
        F.xxhash64("text").alias("__h"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("__id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.struct(*[c for c in docs.columns if c not in new]).alias("row"))  # so that no names clash
    rows, total, _ = ranged(base, KEY, "size", shards * ranges_per_shard, ["text_crc32"])
    share = max(total, 1) / shards
    group = Window.partitionBy(RANGE, "__h")
    middle = F.when(F.sum("size").over(group) <= whole_group * share,
                    F.min(START).over(group) + F.sum("size").over(group) / 2
                    ).otherwise(F.col(START) + F.col("size") / 2)
    placed = rows.withColumn("shard", F.least(F.floor(middle / share), F.lit(shards - 1)).cast("int"))
    firsts = placed.groupBy("shard").agg(F.min(ROW).alias("__first"))  # one row per shard
    return (placed.join(F.broadcast(firsts), "shard")
            .withColumns({"slot": F.col(ROW) - F.col("__first"), "law": F.lit("bytes"),
                          "grown_shard": F.lit(None).cast("int")})
            .select("row.*", *new))
