"""Near-duplicate embeddings by spherical-cap filters, verified in double precision."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.components import components, staged
from pulselake.llm.grouped import block_pairs, groups
from pulselake.llm.text import NULL_ID

PARTS = 3  # of a filter
FILTERS_PER_VECTOR = 48  # list-decoded on average
LEAST_FILTERS = 24  # a vector with fewer is decoded again at a lower threshold
FILTERS_PER_ROW = 400  # of the code, for each vector of the largest label: few strangers share one
MAX_WORDS = 1200  # a part's code words; their third power fits an int
BLOCK = 512
NODE = "struct<id: bigint, h: bigint>"


class ProductCode:
    """Filters made of one random direction for each part of a randomly turned vector.

    A filter's score is the sum of its parts' scores, so all filters above the threshold are
    found part by part, leaving out what the best of the remaining parts cannot lift above it.
    """

    def __init__(self, dim: int, size: int, wanted: float):
        r = np.random.Generator(np.random.PCG64([dim, size]))
        self.turn = np.linalg.qr(r.standard_normal((dim, dim)))[0]
        parts = min(PARTS, dim)
        self.cuts = [(dim * i // parts, dim * (i + 1) // parts) for i in range(parts)]
        self.size, self.words = size, []
        for a, b in self.cuts:
            w = r.standard_normal((size, b - a))
            self.words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(parts))
        # The threshold at which random directions have as many filters as wanted.
        probe = r.standard_normal((64, dim))
        probe /= np.linalg.norm(probe, axis=1, keepdims=True)
        low, high = 0.0, 1.0
        for _ in range(12):
            self.least = (low + high) / 2
            few = self._decode(probe, self.least, int(4 * wanted * len(probe)))
            low, high = (low, self.least) if few is not None and len(few[0]) < wanted * len(probe) else (self.least, high)
        self.least = low

    def _decode(self, x: np.ndarray, least: float, most: int | None = None):
        scores = [(x @ self.turn)[:, a:b] @ w.T for (a, b), w in zip(self.cuts, self.words)]
        rest = np.cumsum([s.max(1) for s in scores[::-1]], axis=0)[::-1]
        row, code, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
        for i, s in enumerate(scores):
            need = least - (rest[i + 1] if i + 1 < len(scores) else np.zeros(len(x)))
            found = []
            for at in range(0, len(row), 4096):
                part = slice(at, at + 4096)
                sums = total[part, None] + s[row[part]]
                k, j = np.nonzero(sums >= need[row[part], None])
                found.append((row[part][k], code[part][k] * self.size + j, sums[k, j]))
                if most and sum(len(f[0]) for f in found) > 64 * most:
                    return None
            row, code, total = (np.concatenate(f) for f in zip(*found)) if found else (row[:0], code[:0], total[:0])
        return row, code

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for all filters that a row's score exceeds."""
        todo, least, found = np.arange(len(unit)), self.least, []
        wanted = min(LEAST_FILTERS, self.size ** len(self.cuts))
        while len(todo):
            row, code = self._decode(unit[todo], least)
            enough = np.bincount(row, minlength=len(todo)) >= wanted
            found.append((todo[row[enough[row]]], code[enough[row]]))
            todo, least = todo[~enough], least - 0.02
        return tuple(np.concatenate(f) for f in zip(*found))


@lru_cache(maxsize=4)
def product_code(dim: int, size: int, wanted: float) -> ProductCode:
    return ProductCode(dim, size, wanted)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, unit rows) of binary doubles of one length."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
    return x, x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable():
    """Whether a row can have links."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0), F.lit(False))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(__id, label, dim, vec): rows that can have links; vec holds the components as binary doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            flat = np.asarray(rows.column(2).flatten().cast(pa.float64()))
            ends = np.cumsum(np.asarray(rows.column(3)))
            vec = [flat[b - n:b].tobytes() for b, n in zip(ends, np.asarray(rows.column(3)))]
            yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in (0, 1, 3)], pa.array(vec, pa.binary())],
                                             ["__id", "label", "dim", "vec"])

    e = F.col("embedding")
    return (vectors.filter(_usable())
            .select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("__id"), F.xxhash64("label").alias("label"),
                    F.transform(e, lambda v: v.cast("double")).alias("embedding"), F.size(e).cast("long").alias("dim"))
            .mapInArrow(run, "__id long, label long, dim long, vec binary"))


def _decoded(distinct: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(label, dim, filter, node): the filters of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            dims = np.asarray(rows.column(1))
            for dim in np.unique(dims):
                part = rows.filter(pa.array(dims == dim))
                for at in range(0, len(part), 256):
                    some = part.slice(at, 256)
                    row, code = product_code(int(dim), sizes[int(dim)], FILTERS_PER_VECTOR).decode(_vectors(some.column(3))[1])
                    some = some.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), some.column(1), pa.array(code, pa.int64()), some.column(2)],
                        ["label", "dim", "filter", "node"])

    return distinct.select("label", "dim", "node", "vec").mapInArrow(
        run, f"label long, dim long, filter long, node {NODE}")


def _linked(members: DataFrame, cosine: float) -> DataFrame:
    """(node, links, other): per group the links of each node there, and a forest of them.

    A pair is counted in the first filter that both have, so in one group only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["label", "dim", "filter", "x", "y"]):
            side, copies = group["side"].to_numpy(), group["copies"].to_numpy()
            left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
            unit = _vectors(group["vec"].combine_chunks())[1]
            near = unit[left] @ unit[right].T >= cosine
            near &= left[:, None] != right[None, :]
            if not near.any():
                continue
            here = group["filter"][0].as_py()
            lists = [np.frombuffer(b, np.int64) for b in group["filters"].to_pylist()]
            known, at = np.unique(np.concatenate(lists), return_inverse=True)
            have = np.zeros((len(side), len(known)), np.float32)
            have[np.repeat(np.arange(len(side)), [len(f) for f in lists]), at] = 1
            have = have[:, known < here]
            first = near & ~((have[left] @ have[right].T) > 0)
            links = np.zeros(len(side), np.int64)
            links[left] += first @ copies[right]
            if (side > 0).any():
                links[right] += first.T @ copies[left]
            # A forest: the nodes reached from the first one not reached yet hang on it.
            hub = np.full(len(side), -1)
            for start in range(len(side)):
                if hub[start] >= 0:
                    continue
                todo = [start]
                hub[start] = start
                while todo:
                    i = todo.pop()
                    reach = np.zeros(len(side), bool)
                    reach[right[near[left == i].any(0)]] = True
                    reach[left[near[:, right == i].any(1)]] = True
                    new = np.flatnonzero(reach & (hub < 0))
                    hub[new] = start
                    todo.extend(new)
            node = group["node"].combine_chunks()
            use = np.flatnonzero((links > 0) | (hub != np.arange(len(side))))
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(use)), pa.array(links[use]), node.take(pa.array(hub[use]))], ["node", "links", "other"])

    return block_pairs(members, ["label", "dim", "filter"], BLOCK).mapInArrow(
        run, f"node {NODE}, links long, other {NODE}")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Rows of equal, not null label link with a cosine of ``cosine`` or more, in double
    precision. Null, empty and zero vectors and those with a null or non-finite component
    link with nothing, as do rows without a label; vectors of different length do not link.
    Equal vectors of a label are one node with a count. Each node is list-decoded to all filters
    that its score exceeds; nodes that share a filter and label meet, in blocks if they are many,
    and are verified. n_links counts other rows, component_id is the least vec_id reachable.
    """
    usable = usable_vectors(vectors)
    distinct = staged(usable.groupBy("label", "dim", "vec").agg(F.min("__id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                      .select("label", "dim", "vec", "copies",
                              F.struct(F.col("rep").alias("id"), F.xxhash64("label", "vec").alias("h")).alias("node")), "vectors")
    crowds = distinct.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("n")).collect()  # one row per length
    sizes = {r["dim"]: min(MAX_WORDS, max(8, round((FILTERS_PER_ROW * r["n"]) ** (1 / min(PARTS, r["dim"]))))) for r in crowds}
    decoded = staged(_decoded(distinct, sizes), "filters")
    shared = decoded.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    meeting = decoded.join(shared, ["label", "dim", "filter"])
    lists = meeting.groupBy("node").agg(F.sort_array(F.collect_list("filter")).alias("filters"))
    members = (meeting.join(distinct.select("node", "vec", "copies").join(_packed(lists), "node"), "node")
               .select("label", "dim", "filter", "node", "copies", "vec", "filters"))
    found = staged(_linked(members, cosine), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.filter("node != other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    per_node = (distinct.join(links, "node", "left").join(classes, "node", "left")
                .select("label", "dim", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                        F.coalesce("component.id", "node.id").alias("component")))
    linked = usable.join(per_node, ["label", "dim", "vec"]).select("__id", "links", "component")
    own = F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID))
    alone = vectors.filter(~_usable()).select(own.alias("__id"), F.lit(0).cast("long").alias("links"), own.alias("component"))
    both = linked.unionByName(alone)
    return both.select(_plain("__id").alias("vec_id"), F.col("links").alias("n_links"),
                       _plain("component").alias("component_id"), (F.col("__id") == F.col("component")).alias("kept"))


def _plain(c: str):
    return F.when(F.col(c) != NULL_ID, F.col(c))


def _packed(lists: DataFrame) -> DataFrame:
    """The lists as binary longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            values = [np.asarray(v, np.int64).tobytes() for v in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(values, pa.binary())], ["node", "filters"])

    return lists.mapInArrow(run, f"node {NODE}, filters binary")
