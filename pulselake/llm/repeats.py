"""Where texts may repeat a window that another place has: anchors, contexts, removals.

A window of W units (bytes or words) is assigned to its anchor, the place in it whose gram has
the least hash; equal windows have equal anchors at the same offset. Only anchors whose gram
recurs can hold a repeated window, so only what surrounds those goes on to the step that
compares texts. This holds for every window of every text; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.components import staged
from pulselake.llm.text import FINGERPRINT, ID, TEXT, keyed, partitions, plain_id
from pulselake.llm.vectorized import BLOCK_BYTES, blocks, gram_hashes, mix

KEY = "__key"  # of a row: a hash of id and fingerprint
PLACE_BITS = np.uint64(28)
HOT = 3000  # places of an anchor that one group takes; those of one with more go by window

CONTEXT = f"anchor long, {ID} long, {FINGERPRINT} long, {KEY} long, start long, context binary"
REMOVAL = f"{KEY} long, starts binary, stops binary"


@dataclass(frozen=True)
class Units:
    """What a text is made of, and how long a window is."""

    window: int
    gram: int
    # (bytes, offsets) of a block -> (unit hashes, first unit of each text, start and end byte of each unit)
    split: Callable[[np.ndarray, np.ndarray], tuple]
    # (raw bytes, start and end bytes, from unit, to unit) -> the units as bytes
    cut: Callable[[bytes, np.ndarray, np.ndarray, int, int], bytes]
    # whether a repetition within one text counts
    within: bool
    # bytes of text that a task looks at together: some sixty times as many are held for byte units
    block: int = BLOCK_BYTES


@dataclass
class Anchors:
    """Of each anchor in a block: place, hash, text, and its windows' first and last start."""

    place: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray


def find_anchors(units: np.ndarray, first: np.ndarray, kind: Units) -> Anchors:
    """The anchors of all windows that lie within one text; ties go to the leftmost place."""
    grams = gram_hashes(units, kind.gram)
    span = kind.window - kind.gram + 1
    if len(grams) < span:
        none = np.zeros(0, np.int64)
        return Anchors(none, none.astype(np.uint64), none, none, none)
    least = ((grams >> PLACE_BITS) << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    place = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:len(place)]
    starts = np.flatnonzero(np.arange(len(place)) + kind.window <= first[text + 1])
    place = place[starts]
    edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    last = np.concatenate([edge[1:], [len(place)]]) - 1 if len(place) else edge
    return Anchors(place[edge], grams[place[edge]], text[starts[edge]], starts[edge], starts[last])


def _row_keys(rows: pa.RecordBatch) -> np.ndarray:
    return np.asarray(rows.column(rows.schema.get_field_index(KEY)))


def recurring_anchors(docs: DataFrame, kind: Units) -> DataFrame:
    """(__key, places, hot): per row the places of anchors that recur, and hashes that are hot.

    A block of texts asks about each distinct hash in it once, whatever its number, so
    a hash gets no more rows than there are blocks. What recurs within the block is known
    already and goes straight through. The hashes travel packed, by range.
    """
    buckets = 4 * partitions(docs)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 2, kind.block):
            units, first, *_ = kind.split(data, offsets)
            found = find_anchors(units, first, kind)
            if not len(found.place):
                continue
            keys = _row_keys(rows)[found.text]
            place = (found.place - first[found.text]).astype(np.int64)
            hashes, at, back, count = np.unique(found.hash, return_index=True, return_inverse=True, return_counts=True)
            again = np.flatnonzero(count[back] > 1)
            out = []
            bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            for part in np.split(np.arange(len(hashes)), np.flatnonzero(np.diff(bucket)) + 1):
                out.append((int(bucket[part[0]]), hashes[part].tobytes(), keys[at[part]].tobytes(),
                            place[at[part]].tobytes(), count[part].astype(np.int64).tobytes()))
            if len(again):
                out.append((int(keys[again[0]] % buckets), b"", keys[again].tobytes(), place[again].tobytes(), b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in range(1, 5)]],
                ["bucket", "hashes", "keys", "places", "counts"])

    def known(keys: np.ndarray, places: np.ndarray, hot: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        cuts = np.flatnonzero(np.diff(keys)) + 1
        each = [p.tobytes() for p in np.split(places, cuts)] if len(keys) else []
        who = keys[np.concatenate([[0], cuts])] if len(keys) else keys
        return pa.RecordBatch.from_arrays(
            [pa.array([*who, *[None] * len(hot)], pa.int64()), pa.array([*each, *[None] * len(hot)], pa.binary()),
             pa.array([*[None] * len(who), *hot.view(np.int64)], pa.int64()),
             pa.array([*[None] * len(who), *counts], pa.int64())], [KEY, "places", "hot", "n"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulselake.llm.grouped import groups
        none = np.zeros(0, np.int64)
        for group in groups(batches, ["bucket"]):
            asked = [i for i, h in enumerate(group["hashes"].to_pylist()) if h]
            passed = [i for i in range(len(group)) if i not in set(asked)]

            def joined(name: str, which: list[int], kind_of=np.int64) -> np.ndarray:
                column = group[name]
                return np.frombuffer(b"".join(column[i].as_py() for i in which), kind_of)

            if passed:
                yield known(joined("keys", passed), joined("places", passed), none, none)
            if asked:
                hashes = joined("hashes", asked, np.uint64)
                found, back, blocks_of = np.unique(hashes, return_inverse=True, return_counts=True)
                total = np.bincount(back, joined("counts", asked), len(found)).astype(np.int64)
                recurs = np.flatnonzero(blocks_of[back] > 1)
                hot = np.flatnonzero(total > HOT)
                yield known(joined("keys", asked)[recurs], joined("places", asked)[recurs], found[hot], total[hot])

    return (docs.mapInArrow(ask, "bucket int, hashes binary, keys binary, places binary, counts binary")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(answer, f"{KEY} long, places binary, hot long, n long"))


def contexts(suspects: DataFrame, kind: Units, hot: frozenset) -> DataFrame:
    """Rows of CONTEXT: the units around each recurring anchor that its windows cover, and where they start.

    Equal contexts within a block go on once, at their first place; what follows is a
    repetition whatever the rest of the corpus holds and comes out as a removal at once (a row
    without an anchor: start, and the stop as the fingerprint). The windows of a hot anchor go on
    one by one by their own hash, so that no group gathers all its places.
    """
    listed = np.array(sorted(hot), np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 2, kind.block):
            units, first, begins, ends = kind.split(data, offsets)
            found = find_anchors(units, first, kind)
            if not len(found.place):
                continue
            raw = data.tobytes()
            ids, fps, keys = (np.asarray(rows.column(i)) for i in (0, 1, 3))
            wanted = [np.frombuffer(b"".join(p), np.int64) + first[i] for i, p in enumerate(rows.column(4).to_pylist())]
            use = np.flatnonzero(np.isin(found.place, np.concatenate(wanted)))
            use = use[np.lexsort((found.place[use], fps[found.text[use]], ids[found.text[use]]))]
            many = np.isin(found.hash[use], listed)
            spans = []  # (group, anchor's text, from, to)
            windows = gram_hashes(units, kind.window) if many.any() else None
            for i, m in zip(use, many):
                if m:
                    for s in range(found.low[i], found.high[i] + 1):
                        spans.append((int(windows[s].view(np.int64)), found.text[i], s, s + kind.window))
                else:
                    spans.append((int(found.hash[i].view(np.int64)), found.text[i], found.low[i], found.high[i] + kind.window))
            seen: dict[tuple, int] = {}
            out = []
            for group, t, a, b in spans:
                text = kind.cut(raw, begins, ends, a, b)
                owner = seen.setdefault((group, text), t)
                start = int(a - first[t])
                if ids[owner] != ids[t] or (kind.within and fps[owner] != fps[t]):
                    out.append((None, None, int(start + b - a), int(keys[t]), start, None))
                else:
                    out.append((group, int(ids[t]), int(fps[t]), int(keys[t]), start, text))
                if len(out) >= 4096:
                    yield _context_rows(out)
                    out = []
            yield _context_rows(out)

    return suspects.select(ID, FINGERPRINT, TEXT, KEY, "places").mapInArrow(run, CONTEXT)


def _context_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                                      ["anchor", ID, FINGERPRINT, KEY, "start", "context"])


def _applied(rows: DataFrame, kind: Units, join: bytes, out: str) -> DataFrame:
    """(doc_id's key, n_units, n_removed, n_spans, kept): the removals taken out of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, 1, kind.block):
            _, first, begins, ends = kind.split(data, offsets)
            raw, result = data.tobytes(), []
            lists = zip(*[part.column(c).to_pylist() for c in (2, 3, 4)])
            for i, (starts, stops, copy) in enumerate(lists):
                n = int(first[i + 1] - first[i])
                steps = np.zeros(n + 1, np.int64)
                if copy and n >= kind.window:
                    steps[0] = 1
                elif starts:
                    np.add.at(steps, np.frombuffer(b"".join(starts), np.int64), 1)
                    np.add.at(steps, np.frombuffer(b"".join(stops), np.int64), -1)
                gone = np.concatenate([[False], np.cumsum(steps[:n]) > 0, [False]])
                edges = np.flatnonzero(gone[1:] != gone[:-1])
                kept = np.concatenate([[0], edges, [n]]).reshape(-1, 2)  # runs that stay
                pieces = [kind.cut(raw, begins, ends, first[i] + a, first[i] + b) for a, b in kept.tolist() if a < b]
                result.append((n, int(gone.sum()), len(edges) // 2, join.join(pieces)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array([r[k] for r in result], pa.int64()) for k in range(3)],
                 pa.array([r[3] for r in result], pa.binary()).cast(pa.binary() if out == "binary" else pa.string())],
                [ID, "n_units", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, f"{ID} long, n_units long, n_removed long, n_spans long, kept {out}")


def without_repeats(docs: DataFrame, kind: Units, compare: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                    join: bytes, out: str) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept) per row of ``docs``.

    ``compare`` gets the contexts sorted by anchor and returns rows of REMOVAL. The texts
    are shuffled once, for both the contexts and the result. A whole text that a smaller id has
    too goes in one piece, as every window of it is there: such copies are told by two hashes of 64
    bits with seeds of their own and the length, without their texts, and give no contexts.
    """
    n = partitions(docs)
    base = keyed(docs).withColumn(KEY, F.xxhash64(ID, FINGERPRINT))
    same = [FINGERPRINT, "__fp2", "__size"]
    ids = base.select(KEY, ID, FINGERPRINT, F.xxhash64(F.lit(1), TEXT).alias("__fp2"), F.octet_length(TEXT).alias("__size"))
    copies = staged(ids.join(ids.groupBy(*same).agg(F.min(ID).alias("least")), same).filter(F.col(ID) > F.col("least"))
                    .select(KEY).distinct(), "copies").repartition(n, KEY).withColumn("copy", F.lit(True))
    found = staged(recurring_anchors(base, kind), "anchors")
    total = found.select(F.sum(F.length("places") / 8)).first()[0] or 0
    share = total / (8 * n)  # so there are at most 8 n of them
    hot = frozenset(r["hot"] for r in found.filter(F.col("n") > max(HOT, share)).select("hot").collect())
    texts = base.repartition(n, KEY)
    places = (found.filter(f"{KEY} IS NOT NULL").repartition(n, KEY).groupBy(KEY)
              .agg(F.collect_list("places").alias("places")))
    # Not an anti-join: that would be pushed below the shuffle, which is to be shared.
    suspects = texts.join(places, KEY).join(copies, KEY, "left").filter("copy IS NULL")
    around = contexts(suspects, kind, hot)
    # A removal known already goes to any task: it has no anchor to meet others by.
    removals = (around.repartition(n, F.coalesce("anchor", KEY)).sortWithinPartitions("anchor")
                .mapInArrow(compare, REMOVAL).repartition(n, KEY).groupBy(KEY)
                .agg(F.collect_list(F.struct("starts", "stops")).alias("r"))
                .select(KEY, F.col("r.starts").alias("starts"), F.col("r.stops").alias("stops")))
    # The fingerprint goes along so that both uses of the texts read the same columns, and
    # with that the same shuffle files.
    rows = texts.join(removals, KEY, "left").join(copies, KEY, "left").select(ID, TEXT, "starts", "stops", "copy", FINGERPRINT)
    return _applied(rows, kind, join, out).select(plain_id(), "n_units", "n_removed", "n_spans", "kept")


def equal_contexts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[list[tuple]]]:
    """Batches of anchor groups; a group lists (context, places), a place is (id, fingerprint, start, key).

    Removals that are known already come out as groups without a context: [(None, places)].
    About ``most`` bytes of different contexts are held at a time.
    """
    held, size, last, current = [], 0, None, {}
    for rows in batches:
        columns = [c.to_pylist() for c in rows.columns]
        for anchor, i, fp, key, start, context in zip(*columns):
            if anchor is None:
                held.append([(None, [(start, fp, key)])])
                continue
            if anchor != last:
                if current:
                    held.append(list(current.items()))
                if size >= most or len(held) >= 50_000:
                    yield held
                    held, size = [], 0
                current, last = {}, anchor
            if context not in current:
                current[context] = []
                size += len(context)
            current[context].append((i, fp, start, key))
    if current:
        held.append(list(current.items()))
    if held:
        yield held


class Removals:
    """Spans to remove, gathered by row key and put out in packed rows, some hundred thousand at a time."""

    def __init__(self, most: int = 300_000):
        self.most, self.parts, self.held = most, [], 0

    def add(self, keys, starts, stops) -> None:
        self.parts.append([np.asarray(x, np.int64) for x in (keys, starts, stops)])
        self.held += len(self.parts[-1][0])

    def rows(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if not self.held or (self.held < self.most and not last):
            return
        keys, starts, stops = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.held = [], 0
        order = np.lexsort((starts, keys))
        keys, starts, stops = keys[order], starts[order], stops[order]
        cuts = np.flatnonzero(np.diff(keys)) + 1
        packed = [[x.tobytes() for x in np.split(v, cuts)] for v in (starts, stops)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[np.concatenate([[0], cuts])]), *[pa.array(v, pa.binary()) for v in packed]], [KEY, "starts", "stops"])


def spans_of(owners: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, stop) of the runs that the windows at ``offsets`` of each owner cover."""
    if not len(owners):
        return owners, offsets, offsets
    order = np.lexsort((offsets, owners))
    owners, offsets = owners[order], offsets[order]
    new = np.flatnonzero((np.diff(owners, prepend=-1) != 0) | (np.diff(offsets, prepend=-2) > 1))
    last = np.concatenate([new[1:], [len(owners)]]) - 1
    return owners[new], offsets[new], offsets[last] + window
