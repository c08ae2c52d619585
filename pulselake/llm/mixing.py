"""Interleaving sources by target weights: Pfair windows, earliest deadline first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.ranges import RANGE, ROW, cut, numbered
from pulselake.llm.text import NULL_ID

MAX_SOURCES = 100_000
NEVER = (1 << 63) - 1  # later than any block


def quotas(weights: Mapping, frame: int) -> dict:
    """Whole blocks per frame, by largest remainder; sources of positive weight get one at least."""
    total = sum(weights.values())
    exact = {s: frame * w / total for s, w in weights.items() if w > 0}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))
    i = 0
    while sum(out.values()) != frame:
        if sum(out.values()) < frame:
            out[order[i % len(order)]] += 1
        else:
            big = max(out, key=lambda s: (out[s] - exact[s], out[s], str(s)))
            out[big] -= 1
        i += 1
    return out


def pfair_frame(quota: Mapping, frame: int) -> list[tuple]:
    """(source, k, slot, release, deadline) of each block k of each source in one frame.

    Block k of a source with q of the frame's slots is released at floor(k frame / q) and
    due by ceil((k + 1) frame / q). Among the released blocks the earliest deadline goes
    first (then the earlier release, then the source's name), so every block is in its window and
    at any slot each source is less than one block from its share. ``mix`` does not repeat such
    frames, as their quotas are rounded: see ``schedule``.
    """
    coming = sorted((k * frame // q, -(-(k + 1) * frame // q), str(s), k, s) for s, q in quota.items() for k in range(q))
    ready, out, i = [], [], 0
    for slot in range(frame):
        while i < len(coming) and coming[i][0] <= slot:
            release, due, name, k, s = coming[i]
            heapq.heappush(ready, (due, release, name, k, i))
            i += 1
        due, release, _, k, at = heapq.heappop(ready)
        out.append((coming[at][4], k, slot, release, due))
    return out


def capped_shares(counts: Mapping, ceiling: float) -> dict:
    """Each source's share of the rows, none above ``ceiling`` where the others can make up for it."""
    total = sum(counts.values())
    shares = {s: n / total for s, n in counts.items()}
    if len(shares) * ceiling <= 1:
        return {s: 1 / len(shares) for s in shares}
    capped: set = set()
    while True:
        rest = sum(v for s, v in shares.items() if s not in capped)
        scale = (1 - ceiling * len(capped)) / rest
        over = {s for s, v in shares.items() if s not in capped and v * scale > ceiling}
        if not over:
            return {s: ceiling if s in capped else v * scale for s, v in shares.items()}
        capped |= over


def source_counts(docs: DataFrame) -> dict:
    """Rows by source; one line per source comes to the driver, MAX_SOURCES at most."""
    rows = docs.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return {r["source"]: r["count"] for r in rows}


def kept_counts(counts: Mapping, ceiling: float) -> dict:
    """The most rows of each source so that none has more than ``ceiling`` of all that are kept.

    Only sources above the ceiling lose rows. Fewer than 1 / ceiling sources cannot hold it,
    whatever is kept; they keep all.
    """
    limit = Fraction(ceiling).limit_denominator(10 ** 9)
    if len(counts) * limit < 1:
        return dict(counts)
    capped: set = set()
    while True:
        whole = Fraction(sum(n for s, n in counts.items() if s not in capped)) / (1 - limit * len(capped))
        over = {s for s, n in counts.items() if s not in capped and n > limit * whole}
        if not over:
            return {s: int(limit * whole) if s in capped else n for s, n in counts.items()}
        capped |= over


def schedule(sources: Sequence[tuple], total: int, block: int) -> Iterator[tuple]:
    """(number, k, at, taken, rest, release, deadline) of each block k of each source, in turn.

    A source is (number, rows, most, numerator, denominator): its exact weight is the
    fraction, and ``most`` of its rows may be among the ``total`` of the mix. After n rows of
    the mix, the block that starts with a source's row m may come if m < weight (n + block);
    among those the one with the earliest deadline goes, the rows up to its end over the weight.
    So a source never is a block or more ahead, and since a block starts up to
    one block early, none is late, partial last blocks included: at every row each source is less
    than one block from its weight.

    ``at`` is the place of a block's first row, ``taken`` how many of its rows are in the mix; ``rest`` is
    the place of the first row that is not: those follow the mix by their deadlines. release
    and deadline are floor(k / weight) and ceil((k + 1) / weight), in blocks. A line per source is held.
    """
    def due(i: int, end: int) -> int:  # the place by which row ``end`` of the source is to be there
        return -(-end * sources[i][4] // sources[i][3])

    def line(i: int, k: int, at, taken: int, rest) -> tuple:
        number, _, _, p, q = sources[i]
        return number, k, at, taken, rest, min(k * q // p, NEVER), min(-(-(k + 1) * q // p), NEVER)

    def following(i: int, m: int) -> tuple:
        _, _, most, p, q = sources[i]
        return m * q // p - block + 1, due(i, min(m + block, most)), i, m

    coming = [following(i, 0) for i, s in enumerate(sources) if s[2]]
    heapq.heapify(coming)
    ready: list = []
    done = [0] * len(sources)
    cut_at: dict = {}
    n = 0
    while n < total:
        while coming and coming[0][0] <= n:
            release, by, i, m = heapq.heappop(coming)
            heapq.heappush(ready, (by, release, i, m))
        _, _, i, m = heapq.heappop(ready)
        take = min(block, sources[i][2] - m, total - n)
        done[i] = m + take
        if take < block and m + take < sources[i][1]:
            cut_at[i] = n, take
        else:
            yield line(i, m // block, n, take, None)
        n += take
        if done[i] < sources[i][2] and n < total:
            heapq.heappush(coming, following(i, m + take))
    beyond = [(due(i, min(done[i] // block * block + block, s[1])), i) for i, s in enumerate(sources) if done[i] < s[1]]
    heapq.heapify(beyond)
    while beyond:
        _, i = heapq.heappop(beyond)
        at, taken = cut_at.pop(i, (None, 0))
        k = done[i] // block
        end = min((k + 1) * block, sources[i][1])
        yield line(i, k, at, taken, n)
        n += end - done[i]
        done[i] = end
        if end < sources[i][1]:
            heapq.heappush(beyond, (due(i, min(end + block, sources[i][1])), i))


def _planned(spark, sources: Sequence[tuple], total: int, block: int, first_rows: Mapping, starts: Sequence[tuple],
             frame: int) -> DataFrame:
    """(__range, plan): for each range of rows its blocks in order, as ``schedule`` has them.

    One task goes through the blocks and holds a line per source and ``frame`` blocks.
    ``first_rows`` gives each source's first row, ``starts`` each range and its first row.
    """
    names = ["b", "at", "taken", "rest", "release", "deadline"]
    rows_of = {s[0]: s[1] for s in sources}
    # Blocks are numbered through all sources, in the order of the rows.
    first_block = dict(zip(first_rows, accumulate([0, *(-(-rows_of.get(s, 0) // block) for s in first_rows)])))
    ranges, edges = (np.array(x, np.int64) for x in zip(*starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list) -> pa.RecordBatch:
            head = np.array([(first_rows[x[0]] + x[1] * block, first_block[x[0]] + x[1],
                              first_rows[x[0]] + min((x[1] + 1) * block, rows_of[x[0]]) - 1) for x in held], np.int64)
            low, high = (np.searchsorted(edges, head[:, c], "right") - 1 for c in (0, 2))
            copies = high - low + 1  # a block may lie across ranges
            back = np.repeat(np.arange(len(held)), copies)
            places = np.repeat(low - np.cumsum(copies) + copies, copies) + np.arange(len(back))
            columns = [pa.array(list(x), pa.int64()).take(pa.array(back)) for x in list(zip(*held))[2:]]
            return pa.RecordBatch.from_arrays(
                [pa.array(ranges[places], pa.int32()), pa.array(head[back, 1]), *columns], [RANGE, *names])

        for _ in batches:
            held = []
            for x in schedule(sources, total, block):
                held.append(x)
                if len(held) >= frame:
                    yield packed(held)
                    held = []
            if held:
                yield packed(held)

    lines = spark.range(0, 1, 1, 1).mapInArrow(run, f"{RANGE} int, " + ", ".join(f"{n} long" for n in names))
    return lines.groupBy(RANGE).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("plan"))


def mix(docs: DataFrame, weights: Mapping | None = None, ceiling: float = 1 / 3, block: int = 8,
        frame: int = 10_000, ranges: int = 256) -> DataFrame:
    """Every row of ``docs`` with block, release, deadline, position and in_mix.

    ``weights`` gives the target weight of each source (null is a source too). Without
    them only sources above ``ceiling`` lose rows, as ``kept_counts`` has it, and each one's weight
    is its part of the rows that are kept. A source's rows, in the order of a hash of their
    id, form blocks of ``block`` rows, the last one of what is left. Blocks are
    scheduled over the whole run by the exact weights, as in ``schedule``; release and deadline are in
    blocks from the start, position in rows. ``frame`` blocks of the schedule are held at a time.

    in_mix is true for the rows of the mix: with given weights up to the place where a
    source with a weight has no row left. Rows beyond follow the mix by their deadlines, rows of sources
    without a weight have no place (null); for both in_mix is false. Equal rows
    have places of their own. An empty table gives no rows.
    """
    new = ["block", "release", "deadline", "position", "in_mix"]
    names = [c for c in docs.columns if c not in new]
    counts = source_counts(docs)
    known = sorted(counts, key=lambda s: (s is not None, str(s)))
    number = {s: i for i, s in enumerate(known)}
    if weights is None:
        most = kept_counts(counts, ceiling)
        total = sum(most.values())
        exact = {s: Fraction(m, total) for s, m in most.items()}
    else:
        given = {s: Fraction(str(w)) for s, w in weights.items() if w > 0 and s in counts}  # 0.1 is a tenth
        exact = {s: w / sum(given.values()) for s, w in given.items()}
        most = counts
        total = int(min((counts[s] / w for s, w in exact.items()), default=0))
    sources = [(number[s], counts[s], most[s], exact[s].numerator, exact[s].denominator) for s in known if s in exact]
    spark = docs.sparkSession
    of = spark.createDataFrame([(s, number[s]) for s in known], f"source {docs.schema['source'].dataType.simpleString()}, __s int")
    rows = docs.select(F.struct(*names).alias("row"), F.col("source").alias("__source"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("__id"),
                       F.xxhash64("doc_id", "text").alias("__h"), F.lit(1).cast("long").alias("__one"))
    rows = rows.join(F.broadcast(of), F.col("__source").eqNullSafe(F.col("source"))).drop("source", "__source")
    rows = rows.withColumn("__s", F.col("__s").cast("long"))
    key = ["__s", "__h", "__id"]
    splitters, totals = cut(rows, key, "__one", ranges)
    placed = numbered(rows, key, "__one", splitters, totals)
    before = dict(zip(known, accumulate([0, *(counts[s] for s in known)])))
    through = dict(zip(known, accumulate([0, *(-(-counts[s] // block) if s in exact else 0 for s in known)])))
    firsts = spark.createDataFrame([(number[s], before[s], through[s] if s in exact else None) for s in known],
                                   "__s long, first long, __b0 long")
    nth = placed.join(F.broadcast(firsts), "__s").withColumn("__n", F.col(ROW) - F.col("first"))
    nth = nth.withColumns({"block": F.expr(f"__n div {block}"), "__o": F.expr(f"__n % {block}")})
    if not sources:
        return nth.select("row.*", "block", *[F.lit(None).cast("long").alias(c) for c in new[1:4]], F.lit(False).alias("in_mix"))
    starts = list(zip(sorted(totals), accumulate([0, *(totals[r][1] for r in sorted(totals))])))
    plan = _planned(spark, sources, total, block, {number[s]: before[s] for s in known}, starts, frame)
    out = nth.join(plan, RANGE, "left").withColumn("__b", F.expr("get(plan, cast(__b0 + block - plan[0].b as int))"))
    taken = F.col("__o") < F.col("__b.taken")
    return out.select(
        "row.*", "block", F.col("__b.release").alias("release"), F.col("__b.deadline").alias("deadline"),
        F.when(taken, F.col("__b.at") + F.col("__o")).otherwise(F.col("__b.rest") + F.col("__o") - F.col("__b.taken")).alias("position"),
        F.coalesce(taken, F.lit(False)).alias("in_mix"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, columns unchanged."""
    return mix(docs, **how).filter("in_mix").select(*docs.columns)
