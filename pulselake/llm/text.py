"""Text expressions shared by the operators; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"  # \x20 and \x09-\x0D

ID, FINGERPRINT, TEXT = "__id", "__fp", "__text"
NULL_ID = -(1 << 63)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, all else unchanged. Pure ASCII text takes the fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def _row_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias(ID), F.xxhash64("text").alias(FINGERPRINT)]


def keyed(docs: DataFrame) -> DataFrame:
    """(__id, __fp, __text): the row key and the text, whatever else ``docs`` has.

    A null id becomes the least long, so it orders before every other id. Rows that
    agree in id and fingerprint of the text are interchangeable copies of one row.
    """
    return docs.select(*_row_key(), F.col("text").cast("string").alias(TEXT))


def whole_rows(docs: DataFrame) -> DataFrame:
    """(__id, __fp, row): the row key and all columns in one struct, so that no names clash."""
    return docs.select(*_row_key(), F.struct(*docs.columns).alias("row"))


def plain_id(c: str = ID) -> Column:
    """The id as it was in the input."""
    return F.when(F.col(c) != NULL_ID, F.col(c)).alias("doc_id")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
