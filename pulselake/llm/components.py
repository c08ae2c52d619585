"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.session import remove_path, shared_dir


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it has no lineage and outlives executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    remove_path(df.sparkSession, df._staged_at)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link: the least node it can reach.

    ``links`` has columns a and b of one orderable type. Each round hangs every larger
    neighbour of a node on the least one (large star), then every smaller one (small star);
    after a number of rounds that grows with the logarithm of the longest path all nodes hang on
    their component's least one. Only counts come to the driver.
    """
    def larger_first(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()

    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = staged(larger_first(links), "links")
    before = fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter("b > a AND b != m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(larger_first(small.unionByName(low.select("a", F.col("m").alias("b")))), "links")
        now = fingerprint(after)
        unstage(edges)
        edges = after
        if now == before:
            break
        before = now
    # Every node now hangs on its component's least one.
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
