"""Lines that many documents repeat, by range-partitioned hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.text import BLANKS, FINGERPRINT, ID, TEXT, keyed, lower_ascii, partitions, plain_id
from pulselake.operators.skew import hot_keys

MIN_HOT_LINES = 2000


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(__id, __fp, pos, h1, h2) of each line whose key is long enough."""
    return (keyed(docs).select(ID, FINGERPRINT, F.posexplode(F.split(F.coalesce(TEXT, F.lit("")), "\n")).alias("pos", "line"))
            .select(ID, FINGERPRINT, "pos", line_key(F.col("line")).alias("key"))
            .filter(F.char_length("key") >= min_chars)
            .select(ID, FINGERPRINT, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))


def repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """(__id, __fp, words): for each document with lines to drop, a compressed bitmap of them.

    words maps n to the bits of lines 64 n to 64 n + 63; words without a bit are left out.
    Line hashes are partitioned by range (their leading bits), sorted by hash, document and
    position, and streamed: a line that follows one of another hash is a first occurrence,
    one that follows another document's adds a document. A hash that many lines share is
    cut further by document, and the slices' counts are put together afterwards; there
    are at most as many such hashes as shuffle partitions, times the slices.

    A key found in ``min_docs`` documents or more loses all its lines (``keep='none'``) or
    all but the first by document and position (``keep='first'``). Rows with equal doc_id
    count as one document. No text is shuffled.
    """
    lines = _hashed_lines(docs, min_chars)
    n = partitions(docs)
    hot = hot_keys(lines.select("h1"), "h1", MIN_HOT_LINES, 1.0 / (4 * n))
    bits = (8 * n - 1).bit_length()
    salt = F.pmod(F.xxhash64(ID), F.lit(4 * n)) if hot else F.lit(0)
    sliced = lines.withColumns({
        "range": F.shiftrightunsigned("h1", 64 - bits),
        "slice": F.when(F.col("h1").isin(hot.keys), salt).otherwise(F.lit(-1)) if hot else F.lit(-1).cast("long")})
    group = Window.partitionBy("range", "slice", "h1", "h2")
    streamed = group.orderBy(ID, FINGERPRINT, "pos")
    marked = (sliced.repartition("range", "slice")
              .withColumns({"nth": F.row_number().over(streamed),
                            "new_doc": (~F.lag(ID).over(streamed).eqNullSafe(F.col(ID))).cast("long")})
              .withColumn("n_docs", F.sum("new_doc").over(group)))
    if hot:
        merged = (marked.filter((F.col("nth") == 1) & (F.col("slice") >= 0)).groupBy("h1", "h2")
                  .agg(F.sum("n_docs").alias("all_docs"),
                       F.min(F.struct(ID, FINGERPRINT, "pos")).alias("first")))
        marked = (marked.join(F.broadcast(merged), ["h1", "h2"], "left")  # hot hashes only
                  .withColumns({"n_docs": F.coalesce("all_docs", "n_docs"),
                                "nth": F.when(F.col("first").isNull(), F.col("nth"))
                                .when(F.struct(ID, FINGERPRINT, "pos") == F.col("first"), F.lit(1))
                                .otherwise(F.lit(2))}))
    dropped = marked.filter(F.col("n_docs") >= min_docs)
    if keep == "first":
        dropped = dropped.filter(F.col("nth") > 1)
    return (dropped.groupBy(ID, FINGERPRINT, F.shiftright("pos", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
            .groupBy(ID, FINGERPRINT)
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")))


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): the bitmaps applied to the texts."""
    def is_kept(_, i):
        return F.coalesce(F.element_at("words", F.shiftright(i, 6)), F.lit(0)).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)) == 0
    text = F.coalesce(F.col(TEXT), F.lit(""))
    lines = F.split(text, "\n")
    return keyed(docs).join(bitmaps, [ID, FINGERPRINT], "left").select(
        plain_id(), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate(F.map_values("words"), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w)),
                   F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("words").isNull(), text).otherwise(
            F.array_join(F.filter(lines, is_kept), "\n")).alias("kept_text"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) per row of ``docs``.

    A null or empty text is one empty line, which has no key and stays. See
    ``repeated_lines`` for what is dropped. An empty table gives no rows.
    """
    return drop_lines(docs, repeated_lines(docs, min_docs, min_chars, keep))
