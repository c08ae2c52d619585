"""Ranked search over an index of bit-sliced Bloom signatures, with exact rescoring.

A document's signature holds each of its terms, and each again for every power of two that its
count reaches. Signatures of like size stand side by side in blocks: a slice is one bit of all of
them, so the slices of a term, taken together, are a bitmap of the documents that may
hold it. Weighted sums of such bitmaps bound every score from above.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.components import staged, unstage
from pulselake.llm.text import FINGERPRINT, ID, TEXT, keyed, plain_id
from pulselake.llm.vectorized import LETTER, LOWER, blocks, hash_words, mix, words

BITS, HASHES = 10, 4  # bits of a signature for each of its entries, before the size is rounded up
SMALLEST = 9  # a signature has at least two to this many bits
BLOCK_DOCS, BLOCK_BITS = 512, 1 << 23
TERMS_HELD = 1 << 20  # of a task's counts, before they are put out
CANDIDATES = 20  # best bounds of an item that are rescored for its threshold
ENTRIES = 500_000  # terms of items that are searched for in one pass; more take more passes
SUB_ENTRIES = 8192  # and in one product of matrices
BROADCAST_BYTES = 32 << 20
SCALE = 1_000_000_000
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def positions(terms: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The HASHES places of each (term, level) in a signature of ``bits``, a power of two."""
    h = mix(terms + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


@dataclass
class Index:
    """blocks: (bits, ids, fps, n, top, slices), a row for some hundred documents: id, fingerprint,
    terms, and count of the most frequent term of each, and bits slices of a bit for each document.
    terms: (term, df), the documents that hold each term's hash. documents, length: N and L."""

    blocks: DataFrame
    terms: DataFrame
    documents: int
    length: int

    def drop(self) -> None:
        unstage(self.blocks)


class _Blocks:
    """Signatures of one task, gathered by size."""

    def __init__(self) -> None:
        self.held: dict[int, list[tuple]] = {}

    def add(self, one: tuple, terms: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        level = np.floor(np.log2(counts)).astype(np.int64)
        size = max(SMALLEST, int(BITS * (level + 1).sum() - 1).bit_length())
        held = self.held.setdefault(size, [])
        held.append((*one, int(counts.max()), terms, level))
        if len(held) >= min(BLOCK_DOCS, max(8, BLOCK_BITS >> size)):
            yield self.block(size)

    def block(self, size: int) -> pa.RecordBatch:
        held = self.held.pop(size)
        slices = np.zeros((1 << size, -(-len(held) // 8)), np.uint8)
        for i, (*_, terms, level) in enumerate(held):
            for at in range(int(level.max()) + 1):
                places = positions(terms[level >= at], at, 1 << size).reshape(-1)
                slices[places, i >> 3] |= 0x80 >> (i & 7)
        columns = [[h[j] for h in held] for j in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([1 << size], pa.int64()),
             *[pa.array([c], pa.list_(pa.int64())) for c in columns], pa.array([slices.tobytes()], pa.binary()),
             *[pa.nulls(1, pa.int64())] * 2], ["kind", "bits", "ids", "fps", "n", "top", "slices", "term", "df"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        for size in sorted(self.held):
            yield self.block(size)


class _Counts:
    """Documents for each term hash, added up within a task."""

    def __init__(self) -> None:
        self.terms, self.counts, self.held = [], [], 0

    def add(self, terms: np.ndarray) -> Iterator[pa.RecordBatch]:
        once, n = np.unique(terms, return_counts=True)
        self.terms.append(once)
        self.counts.append(n)
        self.held += len(once)
        if self.held >= TERMS_HELD:
            self.merge()
            if self.held >= TERMS_HELD // 2:
                yield from self.rest()

    def merge(self) -> None:
        terms, inverse = np.unique(np.concatenate(self.terms), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(self.counts).astype(float)).astype(np.int64)
        self.terms, self.counts, self.held = [terms], [counts], len(terms)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self.merge()
        terms, counts = self.terms[0], self.counts[0]
        for at in range(0, len(terms), 1 << 16):
            part = slice(at, at + (1 << 16))
            m = len(terms[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), *[pa.nulls(m, pa.list_(pa.int64()))] * 4,
                 pa.nulls(m, pa.binary()), pa.array(terms[part].view(np.int64)), pa.array(counts[part])],
                ["kind", "bits", "ids", "fps", "n", "top", "slices", "term", "df"])
        self.terms, self.counts, self.held = [], [], 0


def build_index(docs: DataFrame) -> Index:
    """The index of all rows of ``docs`` that have a term, from their whole texts, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed, counted = _Blocks(), _Counts()
        for rows, data, offsets in blocks(batches, 2):
            lower = LOWER[data]
            starts, ends, first = words(lower, offsets, LETTER)
            terms = hash_words(lower, starts, ends)
            ids, fps = (np.asarray(rows.column(j)) for j in (0, 1))
            each = []
            for i in np.flatnonzero(first[1:] > first[:-1]):
                once, n = np.unique(terms[first[i]:first[i + 1]], return_counts=True)
                each.append(once)
                yield from signed.add((int(ids[i]), int(fps[i]), int(first[i + 1] - first[i])), once, n)
            if each:
                yield from counted.add(np.concatenate(each))
        yield from signed.rest()
        yield from counted.rest()

    out = staged(keyed(docs).mapInArrow(
        run, "kind int, bits long, ids array<long>, fps array<long>, n array<long>, top array<long>, slices binary, "
             "term long, df long"), "lexical-index")
    found = out.filter("kind = 0").drop("kind", "term", "df")
    found._staged_at = out._staged_at
    total = found.agg(F.sum(F.size("ids")).alias("d"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    terms = out.filter("kind = 1").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(found, terms, int(total["d"] or 0), int(total["l"] or 0))


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_part(n: int, documents: int, length: int) -> int:
    """A document's m: 25 and 75 times its length over the mean one."""
    return 25 + (75 * n * documents) // length


def weighted_items(items: DataFrame, index: Index) -> DataFrame:
    """(item_id, __fp, terms): each different item with its terms as (term, hash, times, df)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 2):
            lower = LOWER[data]
            starts, ends, first = words(lower, offsets, LETTER)
            hashes = hash_words(lower, starts, ends).view(np.int64)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            texts = [lower[a:b].tobytes() for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(row)), rows.column(1).take(pa.array(row)), pa.array(texts, pa.binary()),
                 pa.array(hashes)], ["item_id", FINGERPRINT, "word", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    distinct = items.select("item_id", F.xxhash64("text").alias(FINGERPRINT), F.col("text").cast("string").alias(TEXT)
                            ).dropDuplicates(["item_id", FINGERPRINT])
    entries = (distinct.mapInArrow(run, f"item_id {kind}, {FINGERPRINT} long, word binary, term long")
               .groupBy("item_id", FINGERPRINT, "word", "term").agg(F.count(F.lit(1)).alias("times")))
    return (entries.join(index.terms, "term", "left")
            .groupBy("item_id", FINGERPRINT)
            .agg(F.collect_list(F.struct("word", "term", "times", F.coalesce("df", F.lit(0)).alias("df"))).alias("terms")))


@dataclass
class _Queries:
    """Some items, numbered, with their terms and weights, and N and L."""

    items: list[list[tuple[bytes, int, int, int]]]  # (word, hash, times, weight)
    documents: int
    length: int

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first item, term hashes, weights by item and term) for some items at a time."""
        at = 0
        while at < len(self.items):
            to, held = at, 0
            while to < len(self.items) and (to == at or held + len(self.items[to]) <= SUB_ENTRIES):
                held += len(self.items[to])
                to += 1
            terms = sorted({t for item in self.items[at:to] for _, t, _, _ in item})
            column = {t: j for j, t in enumerate(terms)}
            table = np.zeros((to - at, len(terms)))
            for i, item in enumerate(self.items[at:to]):
                for _, t, times, w in item:
                    table[i, column[t]] += times * w
            exact = np.float32 if table.sum(1).max(initial=0) < 1 << 24 else np.float64
            yield at, np.array(terms, np.int64).view(np.uint64), table.astype(exact)
            at = to

    def gains(self, n: list[int], top: list[int]) -> list[np.ndarray]:
        """For each level what a term whose count lies below the next one can add, beyond the level before."""
        m = 8 * np.array([length_part(x, self.documents, self.length) for x in n], np.int64)
        most, out, before = np.array(top, np.int64), [], np.zeros(len(n), np.int64)
        for level in range(int(most.max()).bit_length()):
            tf = np.minimum((1 << level + 1) - 1, most)
            now = SCALE * tf // (1000 * tf + m)
            out.append((now - before).astype(float))
            before = now
        return out

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(times * w * ((SCALE * counts[word]) // (1000 * counts[word] + 8 * m))
                   for word, _, times, w in self.items[item])


def bounds(bits: int, slices: bytes, gains: list[np.ndarray], terms: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Upper bounds of the score of each item (row) in each document (column) of a block."""
    number = len(gains[0])
    packed = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    out, alive, held = np.zeros((len(table), number)), np.arange(len(terms)), None
    for level, gain in enumerate(gains):
        here = np.bitwise_and.reduce(packed[positions(terms[alive], level, bits)], axis=1)
        held = here if held is None else held & here
        some = held.any(1)
        alive, held = alive[some], held[some]
        if not len(alive):
            break
        present = np.unpackbits(held, axis=1, count=number).astype(table.dtype)
        out += (table[:, alive] @ present) * gain
    return out


def _best_bounds(index: Index, queries: _Queries) -> DataFrame:
    """(item, __id, __fp, bound): of each task the items' best bounds."""
    parts = list(queries.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((len(table), 0)) for _, _, table in parts]
        who = [np.zeros((len(table), 0, 2), np.int64) for _, _, table in parts]
        for batch in batches:
            for row in batch.to_pylist():
                gains = queries.gains(row["n"], row["top"])
                names = np.stack([np.array(row["ids"], np.int64), np.array(row["fps"], np.int64)], 1)
                for p, (_, terms, table) in enumerate(parts):
                    found = bounds(row["bits"], row["slices"], gains, terms, table)
                    all_, mine = np.concatenate([best[p], found], 1), len(table)
                    named = np.concatenate([who[p], np.broadcast_to(names, (mine, *names.shape))], 1)
                    if all_.shape[1] > CANDIDATES:
                        keep = np.argpartition(-all_, CANDIDATES - 1, 1)[:, :CANDIDATES]
                        all_ = np.take_along_axis(all_, keep, 1)
                        named = np.take_along_axis(named, keep[:, :, None], 1)
                    best[p], who[p] = all_, named
        for (first, _, _), found, named in zip(parts, best, who):
            i, j = np.nonzero(found > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array((first + i).astype(np.int32)), pa.array(named[i, j, 0]), pa.array(named[i, j, 1]),
                 pa.array(found[i, j])], ["item", ID, FINGERPRINT, "bound"])

    return index.blocks.mapInArrow(run, f"item int, {ID} long, {FINGERPRINT} long, bound double")


def _not_excluded(index: Index, queries: _Queries, least: list[tuple[int, int]]) -> DataFrame:
    """(__id, __fp, items): the documents whose bound does not rank them behind the tenth known of an item.

    ``least`` has for each item that one's score and id, or (0, ...) if fewer are known."""
    parts = list(queries.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, last = (np.array([x[j] for x in least], np.int64) for j in (0, 1))
        for batch in batches:
            for row in batch.to_pylist():
                gains, ids = queries.gains(row["n"], row["top"]), np.array(row["ids"], np.int64)
                at, items = [], []
                for first, terms, table in parts:
                    found = bounds(row["bits"], row["slices"], gains, terms, table)
                    mine = slice(first, first + len(table))
                    line, end = score[mine, None], last[mine, None]
                    keep = (found > line) | ((found == line) & (line > 0) & (ids <= end))
                    i, j = np.nonzero(keep)
                    at.append(j)
                    items.append(first + i)
                at, items = np.concatenate(at), np.concatenate(items)
                order = np.argsort(at, kind="stable")
                docs, starts = np.unique(at[order], return_index=True)
                if len(docs):
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.append(starts, len(at)), pa.int32()), pa.array(items[order].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[docs]), pa.array(np.array(row["fps"], np.int64)[docs]), lists],
                        [ID, FINGERPRINT, "items"])

    return index.blocks.mapInArrow(run, f"{ID} long, {FINGERPRINT} long, items array<int>")


def _rescored(docs: DataFrame, chosen: DataFrame, queries: _Queries) -> DataFrame:
    """(item, __id, score): exact scores above 0 of the chosen items in the chosen documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, who, score = [], [], []
            for row in range(batch.num_rows):
                found = TERM.findall((batch.column(1)[row].as_py() or "").encode().translate(LOWER.tobytes()))
                counts, m = Counter(found), length_part(len(found), queries.documents, queries.length)
                for i in batch.column(2)[row].as_py():
                    s = queries.score(i, counts, m)
                    if s > 0:
                        item.append(i)
                        who.append(batch.column(0)[row].as_py())
                        score.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(who, pa.int64()), pa.array(score, pa.int64())], ["item", ID, "score"])

    size = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("items")).alias("m")).first()
    small = 48 * size["n"] + 4 * (size["m"] or 0) <= BROADCAST_BYTES
    both = keyed(docs).join(F.broadcast(chosen) if small else chosen, [ID, FINGERPRINT])
    return both.select(ID, TEXT, "items").mapInArrow(run, f"item int, {ID} long, score long")


def _top(rows: DataFrame, by: list, most: int) -> DataFrame:
    """The first ``most`` rows of each item; Spark cuts each task's groups before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).filter(F.col("rank") <= most)


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` highest-scoring rows of ``docs`` for each item.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased, of whole texts.
    Equal scores rank by ascending id, a null id first; rows with equal id and text each have a rank.
    A row or item without terms (null or empty text) is in no result, nor is a score of 0. Items that
    agree in id and text are one; a null item id is an id. Empty tables give no rows, further columns
    are not read.

    The index is scanned twice for each half a million terms of items: for the best bounds of
    each item, whose documents are rescored, and, with the ``most``-th of those scores as the line,
    for all documents whose bound does not put them behind it. Those are rescored from their whole
    texts. The items of one pass, at most ENTRIES terms and one item, are sent to the tasks.
    """
    index = build_index(docs)
    known = staged(weighted_items(items, index), "lexical-items")
    entries = known.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    passes = -(-entries // ENTRIES)
    out = None
    for p in range(passes):
        rows = known.filter(F.pmod(F.xxhash64("item_id", FINGERPRINT), F.lit(passes)) == p).collect()
        queries = _Queries([[(bytes(t["word"]), t["term"], t["times"], weight(index.documents, t["df"])) for t in r["terms"]]
                            for r in rows], index.documents, index.length)
        if not rows:
            continue
        best = _top(_best_bounds(index, queries), [F.desc("bound"), ID, FINGERPRINT], max(CANDIDATES, most))
        first = staged(best.groupBy(ID, FINGERPRINT).agg(F.collect_set("item").alias("items")), "lexical-first")
        tenth = (_top(_rescored(docs, first, queries), [F.desc("score"), ID], most)
                 .filter(F.col("rank") == most).collect())  # a row for each item of this pass at most
        least = [(0, 0)] * len(rows)
        for r in tenth:
            least[r["item"]] = (r["score"], r[ID])
        unstage(first)
        chosen = staged(_not_excluded(index, queries, least).dropDuplicates([ID, FINGERPRINT]), "lexical-chosen")
        ranked = _top(_rescored(docs, chosen, queries), [F.desc("score"), ID], most)
        names = docs.sparkSession.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {known.schema['item_id'].dataType.simpleString()}")
        ranked = ranked.join(names, "item").select("item_id", F.col("rank").cast("int"), plain_id(), "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        kinds = {c: known.schema[c].dataType.simpleString() for c in ["item_id"]}
        return docs.sparkSession.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id long, score long")
    return out
