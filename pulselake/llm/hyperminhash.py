"""Near-duplicate documents by HyperMinHash registers, verified on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.components import components, staged
from pulselake.llm.grouped import dealt, groups, met
from pulselake.llm.text import FINGERPRINT, ID, NULL_ID, TEXT, keyed, plain_id, whole_rows
from pulselake.llm.vectorized import BLANK, LOWER, blocks, gram_hashes, hash_words, mix, words

BANDED, BAND = 80, 4  # 20 bands: a pair at 0.8 shares none in 3 of 100,000 cases
REGISTERS = BANDED + 192  # by a second hash, for the estimate alone
MANTISSA = 10  # bits; the leading-zero count takes 6
MARGIN = 0.12  # below the threshold, nearly five standard deviations of the estimate
BLOCK = 2048  # members of a bucket that meet in one group
LOAD = 2 << 20  # shingles of a block
NODE = "struct<id: bigint, h: bigint>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; one for all its words if they are fewer."""
    lower = LOWER[data]
    starts, ends, first = words(lower, offsets, ~BLANK)
    units = hash_words(lower, starts, ends)
    grams = gram_hashes(units, size)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield mix(np.array([xxhash.xxh3_64_intdigest(units[a:b].tobytes())], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers for the bands, then those for the estimate alone."""
    return np.concatenate([_registers(shingles, BANDED), _registers(mix(shingles + np.uint64(1)), REGISTERS - BANDED)])


def _registers(hashes: np.ndarray, number: int) -> np.ndarray:
    """Of the least hash in each bucket: leading zeros and the bits behind the first one; 0 is empty."""
    least = np.full(number, np.iinfo(np.uint64).max, np.uint64)
    bucket = ((hashes >> np.uint64(32)) * np.uint64(number)) >> np.uint64(32)
    value = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    np.minimum.at(least, bucket.astype(np.int64), value)
    zeros = 63 - np.floor(np.log2(np.maximum(least >> np.uint64(11), 1).astype(float))).astype(np.int64) - 11
    zeros = np.minimum(zeros, 62 - MANTISSA)
    behind = (least >> (63 - zeros - MANTISSA).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | behind
    used = np.zeros(number, bool)
    used[bucket.astype(np.int64)] = True
    return np.where(used, out, 0).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of each pair of register rows, less the collisions to be expected by chance."""
    filled = ((a > 0) | (b > 0)).sum(-1)
    same = ((a == b) & (a > 0)).sum(-1)
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    by_chance = 0.169919487159739 * REGISTERS * (4 * ratio / (1 + ratio) ** 2) / 2 ** MANTISSA
    by_chance = by_chance * (filled - same) / np.maximum(filled, 1)  # only registers that differ in truth collide
    return (same - by_chance) / np.maximum(filled, 1)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(__id, __fp, n, h1, h2, registers): size and 128-bit hash of the shingle set, and its registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 2):
            n, h1, h2, sketch = [], [], [], []
            for s in shingle_sets(data, offsets, size):
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                h1.append(h & ((1 << 64) - 1))
                h2.append(h >> 64)
                sketch.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(n, pa.int64()),
                 *[pa.array(np.array(h, np.uint64).view(np.int64)) for h in (h1, h2)], pa.array(sketch, pa.binary())],
                [ID, FINGERPRINT, "n", "h1", "h2", "registers"])

    return keyed(docs).mapInArrow(
        run, f"{ID} long, {FINGERPRINT} long, n long, h1 long, h2 long, registers binary")


def _bands(sets: DataFrame) -> DataFrame:
    """(key, node) for each band of a set with a register that is not empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sketch = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            sketch = sketch[:, :BANDED].reshape(-1, BANDED // BAND, BAND)
            key = np.zeros(sketch.shape[:2], np.uint64) + mix(np.arange(sketch.shape[1], dtype=np.uint64))
            for j in range(BAND):
                key = mix(key ^ sketch[:, :, j].astype(np.uint64))
            row, band = np.nonzero((sketch > 0).any(-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[row, band].view(np.int64)), rows.column(0).take(pa.array(row))], ["key", "node"])

    return sets.select("node", "registers").mapInArrow(run, f"key long, node {NODE}")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose registers estimate a similarity of ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            r = [np.frombuffer(b"".join(rows.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3)]
            n = [np.asarray(rows.column(i)) for i in (4, 5)]
            yield rows.select(["a", "b"]).filter(pa.array(estimate(*r, *n) >= least))

    one = sets.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    two = sets.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(
        run, f"a {NODE}, b {NODE}")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets share ``percent`` in a hundred of their union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for at in range(0, len(rows), 256):
                part = rows.slice(at, 256)
                left = [s for _, d, o in blocks([part], 2) for s in shingle_sets(d, o, size)]
                right = [s for _, d, o in blocks([part], 3) for s in shingle_sets(d, o, size)]
                for s, t in zip(left, right):
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col(TEXT).alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col(TEXT).alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, f"a {NODE}, b {NODE}")


def spanning(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join what links between the sets join: none within a component, or between ones that
    the links before have joined. Sets of one side other than 0 do not meet.

    Sets meet all others one after the other, until those left are of one component. The largest
    component's come last, so that its members do not meet among themselves.
    """
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    n, side, part = n[order], side[order], np.unique(component, return_inverse=True)[1].reshape(-1)[order]
    first = np.concatenate([[0], np.cumsum(n)])
    unit, place = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    mine, waiting, out = np.zeros(len(unit), bool), np.ones(len(n), bool), []
    while True:
        left = np.flatnonzero(waiting)
        largest = np.bincount(part[left]).argmax()
        others = left[part[left] != largest]
        if not len(others) or (side[left] == side[left[0]]).all() and side[left[0]]:
            return out
        i = others[0]
        waiting[i] = False
        # Sets whose sizes differ by more cannot share so much.
        lo, hi = np.searchsorted(100 * n, percent * n[i]), np.searchsorted(percent * n, 100 * n[i], "right")
        fit = (part[lo:hi] != part[i]) & ((side[i] == 0) | (side[lo:hi] != side[i]))
        if not fit.any():
            continue
        mine[place[first[i]:first[i + 1]]] = True
        common = np.add.reduceat(mine[place[first[lo]:first[hi]]].view(np.int8), first[lo:hi] - first[lo], dtype=np.int64)
        mine[place[first[i]:first[i + 1]]] = False
        fit &= 100 * common >= percent * (n[i] + n[lo:hi] - common)
        joined, at = np.unique(part[lo:hi][fit], return_index=True)
        out += [(order[i], order[lo + j]) for j in np.flatnonzero(fit)[at]]
        part[np.isin(part, joined)] = part[i]


def _between(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links between components of one bucket, as many as join what its pairs' links join.

    A large bucket is cut into blocks, which meet two by two in tasks of their own. There the whole sets
    are compared, so that no pair without a link and no link between what is joined leaves a task.
    """
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 1):
            sets = [s.tobytes() for s in shingle_sets(data, offsets, size)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["key", "x", "y"]):
            component = np.array([(c["id"], c["h"]) for c in group["component"].to_pylist()], "i8,i8")
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            found = spanning(sets, component, group["side"].to_numpy(), percent)
            if found:
                node = group["node"].combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(k, pa.int64())) for k in zip(*found)], ["a", "b"])

    whole = (texts.join(members.select("node").distinct(), "node").select("node", TEXT)
             .mapInArrow(shingled, f"node {NODE}, shingles binary"))
    rows = dealt(members, ["key"], BLOCK, "n", LOAD).drop("n").join(whole, "node")
    return met(rows.select("key", "x", "y", "side", "node", "component", "shingles"), ["key"]).mapInArrow(
        run, f"a {NODE}, b {NODE}")


def _star(members: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket with its hub, the node with the most company."""
    hubs = members.groupBy("key").agg(F.max(F.struct("company", F.col("node").alias("hub"))).alias("h"))
    pairs = members.join(hubs.select("key", F.col("h.hub").alias("hub")), "key").filter("node != hub")
    return pairs.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members, with their component, of the buckets that hold more than one and a pair without the hub."""
    labelled = members.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = (labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                           F.count(F.lit(1)).alias("m"))
               .filter("lo != hi AND m > 2").select("key"))
    return labelled.join(several, "key")


def _buckets(sets: DataFrame) -> DataFrame:
    """(key, node, m) of the buckets of several nodes; of buckets with the same nodes, one."""
    bands = _bands(sets)
    crowds = (bands.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("s"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("t"))
              .filter("m > 1").groupBy("m", "s", "t").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times")))
    return bands.join(crowds.select("key", (F.col("m") * F.col("times")).alias("m")), "key")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(__id, __fp, n_shingles, component, class): per row of ``docs`` its set's size and class.

    A row's set holds the distinct runs of ``size`` lower-cased words of its text, or all its
    words as one if they are fewer; without words it is empty and linked with nothing. Rows
    with equal sets are one node, named by the least id. Nodes that agree in a band of registers
    are candidates. Each is first held against the bucket's hub: an estimate from the registers sorts out
    pairs far below the threshold, and the whole sets confirm a link: ``percent`` of the
    union or more is shared. Where a bucket still has several components, their whole sets are held against one
    another in blocks, which put out no more links than join components. component is the least id reachable
    by links, null if the set is empty. No bucket's pairs are made as rows.
    """
    sketched = staged(sketches(docs, size), "sketches")
    node = F.struct(F.col("rep").alias("id"), F.col("h1").alias("h"))
    sets = staged(sketched.filter("n > 0").groupBy("h1", "h2", "n")
                  .agg(F.min(ID).alias("rep"), F.min(F.struct(ID, FINGERPRINT, "registers")).alias("least"))
                  .select(node.alias("node"), "h2", "n", F.col("least.registers").alias("registers"),
                          F.col(f"least.{FINGERPRINT}").alias(FINGERPRINT)), "sets")
    suspects = staged(_buckets(sets), "buckets")
    near = percent / 100 - MARGIN
    # The text that the others in a bucket were made from shares more bands than they do
    # among themselves: the node with the most company is the hub.
    company = suspects.groupBy("node").agg(F.sum("m").alias("company"))
    suspects = staged(suspects.drop("m").join(company, "node"), "company")
    tested = staged(_alike(_star(suspects), sets, near), "stars")
    nodes = suspects.select("node").distinct()
    texts = staged(keyed(docs).join(
        nodes.join(sets.select("node", FINGERPRINT), "node")
        .select("node", F.col("node.id").alias(ID), FINGERPRINT), [ID, FINGERPRINT])
        .dropDuplicates(["node"]).select("node", TEXT), "texts")
    links = staged(_verified(tested, texts, size, percent), "verified")
    classes = staged(components(links), "classes")
    mixed = _mixed(suspects, classes).join(sets.select("node", "n"), "node")
    mixed = staged(mixed.select("key", "node", "component", "n"), "mixed")
    more = staged(_between(mixed, texts, size, percent), "between")
    if not more.isEmpty():
        known = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        classes = components(known.unionByName(more))
    found = sets.join(classes, "node", "left").select(
        F.col("node.h").alias("h1"), "h2", "n", F.coalesce("component", "node").alias("class"))
    return sketched.join(found, ["h1", "h2", "n"], "left").select(
        ID, FINGERPRINT, F.col("n").alias("n_shingles"), F.col("class.id").alias("component"), "class")


def report(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): kept is the document its class is named after."""
    found = near_duplicates(docs, size, percent)
    component = F.coalesce("component", ID)
    return found.select(plain_id(), "n_shingles", F.when(component != F.lit(NULL_ID), component).alias("component_id"),
                        (F.col(ID) == component).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are first, by id and fingerprint, in their class; columns unchanged.

    Texts without words are in no class: they stay, repeated rows of them once.
    """
    found = near_duplicates(docs, size, percent)
    row = F.struct(ID, FINGERPRINT)
    firsts = (found.filter("component IS NOT NULL").groupBy("class").agg(F.min(row).alias("first"))
              .select("first.*"))
    alone = found.filter("component IS NULL").select(ID, FINGERPRINT).distinct()
    return (whole_rows(docs).join(firsts.unionByName(alone), [ID, FINGERPRINT])
            .groupBy(ID, FINGERPRINT).agg(F.first("row").alias("row")).select("row.*"))
