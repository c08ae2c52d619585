"""Benchmark passages in documents: a broadcast set of word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.text import FINGERPRINT, ID, TEXT, keyed, lower_ascii, plain_id, whole_rows

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
MAX_BROADCAST_WINDOWS = 200_000
MAX_LISTED_PAIRS = 50_000


def words(text: Column) -> Column:
    """Runs of digits, letters and all beyond ASCII, A-Z lower-cased; none of a null text."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(1)), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, n, items): each distinct window, its word count and the items it is in."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    each = w.select("item", n.alias("n"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("window"))
    return each.groupBy("window", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _head(w: str, i: Column, n: int) -> Column:
    """A hash of the first one or two words of a window of n words."""
    first = F.get(w, i)
    return F.xxhash64(first, F.get(w, i + 1)) if n > 1 else F.xxhash64(first)


def _spots(n: int, heads: list[int]) -> Column:
    """The windows of n words of the words w, with their place, that begin as one of ``heads`` does."""
    starts = F.sequence(F.lit(0), F.size("w") - n)
    if len(heads) <= MAX_LISTED_PAIRS:
        starts = F.filter(starts, lambda i: _head("w", i, n).isin(heads))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.slice("w", i + 1, n).alias("window")))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(__id, __fp, n_hit, items) of the documents in which a benchmark window occurs.

    The normalised windows of the benchmark are a broadcast set, of which the number is
    counted first. A document is scanned for the first two words of any window; where they
    are found, the whole window is looked up by its words, which verifies the hit. Beyond
    MAX_BROADCAST_WINDOWS the lookup is a shuffle join instead, and beyond MAX_LISTED_PAIRS
    beginnings every position is looked up; results are the same.

    n_hit counts the words inside any hit, items lists the item ids as strings. A window
    is ``size`` consecutive words; an item of fewer words is one window, one of none has none.
    """
    windows = benchmark_windows(benchmark, size)
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most `size`
    listed = {n: windows.filter(F.col("n") == n).select(_head("window", F.lit(0), n).alias("h")).distinct()
              .limit(MAX_LISTED_PAIRS + 1) for n in lengths}
    heads = {n: [r["h"] for r in df.collect()] for n, df in listed.items()}
    small = windows.limit(MAX_BROADCAST_WINDOWS + 1).count() <= MAX_BROADCAST_WINDOWS
    split = keyed(docs).select(ID, FINGERPRINT, words(F.col(TEXT)).alias("w"))
    found = None
    for n in lengths:
        here = F.when(F.size("w") >= n, _spots(n, heads[n]))
        found = here if found is None else F.concat(F.coalesce(found, F.array()), F.coalesce(here, F.array()))
    if found is None:
        return keyed(docs).filter(F.lit(False)).select(
            ID, FINGERPRINT, F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    spots = split.select(ID, FINGERPRINT, F.explode(found).alias("s")).select(ID, FINGERPRINT, "s.at", "s.window")
    hits = spots.join(F.broadcast(windows) if small else windows, "window")
    # Windows in order of their start: each adds the words that the ones before do not reach.
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(a["to"], s["at"]))).alias("n"),
                              F.greatest(a["to"], s["to"]).alias("to")))["n"]
    return (hits.groupBy(ID, FINGERPRINT)
            .agg(F.sort_array(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("to")))).alias("spans"),
                 F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
            .select(ID, FINGERPRINT, covered.cast("long").alias("n_hit"), "items"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, items) per row of ``docs``; a null text has no words."""
    hits = contaminated(docs, benchmark, size)
    counted = keyed(docs).select(ID, FINGERPRINT, F.size(words(F.col(TEXT))).cast("long").alias("n_words"))
    return counted.join(hits, [ID, FINGERPRINT], "left").select(
        plain_id(), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all columns unchanged."""
    hits = contaminated(docs, benchmark, size).select(ID, FINGERPRINT)
    return whole_rows(docs).join(hits, [ID, FINGERPRINT], "left_anti").select("row.*")
