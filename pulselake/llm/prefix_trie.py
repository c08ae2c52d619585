"""The trie of conversation prefixes, by vertical bitmaps over shards of the conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.components import staged
from pulselake.llm.text import partitions

BLOCK_TURNS = 1 << 15  # a block of bitmaps has so many turns at most, or one longer conversation
WORDS = r"[^\x20\x09-\x0D]+"
ROOT = b"root"

# What a task puts out: nodes that are done; nodes whose parent's id or ends are looked up by key;
# pieces of nodes that other tasks may share; ids that end in a node; ids of parents.
DONE, LOOKUP, PIECE, END, PARENT = range(5)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
FIELDS = ([("kind", pa.int32())] + [(c, pa.int64()) for c in NODE]
          + [("ends", pa.binary()), ("key", pa.binary()), ("parent_key", pa.binary()),
             ("part", pa.int32()), ("place", pa.int64()), ("turn", pa.binary()), ("words", pa.int64())])
NAMES = [n for n, _ in FIELDS]
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
SCHEMA = ", ".join(f"{n} {_SQL[t]}" for n, t in FIELDS)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (a, b, words): two hashes of role and
    text and the words of the text. Only these leave the task that read them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORDS)).cast("int").alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "a", "b", "words")))  # null first
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: t.dropFields("turn")).alias("turns"))


def rebuilt(convs: DataFrame, head_of: Column, head: Column, longest: int) -> DataFrame:
    """Each conversation with its first ``head`` turns, at most ``longest``, replaced by those of
    conversation ``head_of`` (all if it has fewer, none if it is absent)."""
    firsts = convs.select(F.col("conv_id").alias("head_of"), F.slice("turns", 1, longest).alias("theirs"))
    own = convs.withColumns({"head_of": head_of, "head": head})
    none = F.slice("turns", 1, 0)
    return own.join(firsts, "head_of", "left").select("conv_id", F.concat(
        F.coalesce(F.slice("theirs", F.lit(1), F.col("head")), none),
        F.slice("turns", F.col("head") + 1, F.size("turns"))).alias("turns"))


@dataclass(frozen=True)
class Limits:
    """What a task holds: conversations of a block; children that wait for their parent's id (more
    are joined with it); ids that end in a node (more are sorted and hashed apart)."""

    block: int = 1024
    waiting: int = 4096
    ends: int = 65536


@dataclass(slots=True)
class _Node:
    """A node on the way from the root to where the task is."""

    depth: int
    turn: bytes
    key: bytes
    words: int
    left: bool  # on the way to the task's first conversation: an earlier task may have a part of it
    place: int
    least: int = 0
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    waiting: list = field(default_factory=list)
    many: bool = False  # children were put out without its id
    ends: list = field(default_factory=list)
    streamed: bool = False  # ends were put out one by one


def _child_key(key: bytes, turn: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key + turn)


def digest(ends: list[int]) -> bytes:
    return hashlib.sha256(",".join(map(str, ends)).encode()).digest()


class _Path:
    """The nodes from the root to the present one, and what is known of them; the rows of all others
    are put out as soon as their last conversation has been seen."""

    def __init__(self, part: int, first: list[bytes], limits: Limits) -> None:
        self.part, self.first, self.limits = part, first, limits
        self.nodes, self.rows, self.places = [], [], 0

    def put(self, kind: int, **columns) -> None:
        self.rows.append((kind, *[columns.get(n) for n in NAMES[1:]]))

    def at(self, depth: int, turn: bytes, words: int) -> _Node:
        """The node of ``turn`` below the present node at depth - 1, new or as it stands."""
        if depth < len(self.nodes):
            if self.nodes[depth].turn == turn:
                return self.nodes[depth]
            self.close(depth)
        above = self.nodes[depth - 1] if depth else None
        left = above is None or (above.left and depth <= len(self.first) and self.first[depth - 1] == turn)
        node = _Node(depth, turn, _child_key(above.key, turn) if above else ROOT, words, left, self.places)
        self.places += 1
        self.nodes.append(node)
        return node

    def add(self, node: _Node, least: int, convs: int, ends: list[int]) -> None:
        node.least = min(node.least, least) if node.convs else least
        node.convs += convs
        node.ends += ends
        if len(node.ends) > self.limits.ends:
            self.stream(node)

    def stream(self, node: _Node) -> None:
        for c in node.ends:
            self.put(END, key=node.key, conv_id=c)
        node.streamed, node.ends = True, []

    def give_up(self, node: _Node) -> None:
        """Put the children that wait out for a join with the node's id."""
        for row in node.waiting:
            self.put(LOOKUP, **row, parent_key=node.key)
        node.waiting, node.many = [], True

    def close(self, depth: int, last: bool = False) -> None:
        """Finish the nodes from ``depth`` on; ``last``: a later task may have a part of them."""
        while len(self.nodes) > depth:
            node = self.nodes.pop()
            if node.left or last:
                self.give_up(node)
                self.stream(node)
                self.put(PIECE, conv_id=node.least, depth=node.depth, n_convs=node.convs, n_children=node.children,
                         n_leaves=node.leaves, saved_tokens=node.saved, key=node.key, part=self.part, place=node.place,
                         turn=node.turn, words=node.words)
                continue  # what lies below it is counted in its piece, itself when the pieces are joined
            above = self.nodes[-1]
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.convs - 1) * node.words
            for row in node.waiting:
                kind = LOOKUP if row["ends"] is None else DONE
                self.put(kind, **{**row, "parent_conv_id": node.least})
            if node.many:
                self.put(PARENT, key=node.key, conv_id=node.least)
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            above.waiting.append({
                "conv_id": node.least, "depth": node.depth, "n_convs": node.convs, "n_children": node.children,
                "n_leaves": leaves, "saved_tokens": saved, "key": node.key,
                "ends": None if node.streamed else digest(node.ends)})
            if node.streamed and node.ends:
                for c in node.ends:
                    self.put(END, key=node.key, conv_id=c)
            if len(above.waiting) > self.limits.waiting:
                self.give_up(above)

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows)
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS)], NAMES)
        self.rows = []
        return out


def _descend(path: _Path, ids: list[int], convs: list[list[bytes]], words: list[list[int]]) -> None:
    """Add a block of conversations, in order of their turns and id, to the path.

    The block's index has a bitmap of conversations for each (position, turn) and for each length.
    Depth first: what a node's bitmap shares with the postings of a turn of its least remaining
    conversation is that child's bitmap.
    """
    postings: dict[tuple[int, bytes], int] = {}
    lengths: dict[int, int] = {}
    for i, conv in enumerate(convs):
        for p, turn in enumerate(conv):
            postings[p, turn] = postings.get((p, turn), 0) | 1 << i
        lengths[len(conv)] = lengths.get(len(conv), 0) | 1 << i

    def members(bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(ids[low.bit_length() - 1])
            bits ^= low
        return out

    todo = [(0, b"", 0, (1 << len(ids)) - 1)]
    while todo:
        depth, turn, count, bits = todo.pop()
        node = path.at(depth, turn, count)
        here = bits & lengths.get(depth, 0)
        path.add(node, min(members(bits)), bits.bit_count(), members(here))
        rest, below = bits ^ here, []
        while rest:
            i = (rest & -rest).bit_length() - 1
            child = bits & postings[depth, convs[i][depth]]
            below.append((depth + 1, convs[i][depth], words[i][depth], child))
            rest &= ~child
        todo += reversed(below)


def _shards(convs: DataFrame, limits: Limits) -> DataFrame:
    """What each shard, a range of the conversations ordered by their turns and then by id, puts out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids, held, words, size = None, [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                conv = [t["a"].to_bytes(8, "big", signed=True) + t["b"].to_bytes(8, "big", signed=True) for t in row["turns"]]
                path = path or _Path(TaskContext.get().partitionId(), conv, limits)
                if ids and (len(ids) >= limits.block or size + len(conv) > BLOCK_TURNS):
                    _descend(path, ids, held, words)
                    ids, held, words, size = [], [], [], 0
                    if path.rows:
                        yield path.batch()
                ids.append(row["conv_id"])
                held.append(conv)
                words.append([t["words"] for t in row["turns"]])
                size += len(conv)
        if path:
            _descend(path, ids, held, words)
            path.close(0, last=True)
            yield path.batch()

    order = ["turns", "conv_id"]
    return (convs.select("turns", "conv_id").repartitionByRange(partitions(convs), *order).sortWithinPartitions(*order)
            .mapInArrow(run, SCHEMA))


def _joined(pieces: DataFrame) -> DataFrame:
    """The nodes that shards share, from their pieces: two paths for each shard, one task.

    In order of shards and places the pieces are in depth-first order, so that those of a
    node follow one another with only deeper ones in between.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[_Node] = []
        rows = []

        def close(depth: int) -> None:
            while len(nodes) > depth:
                node = nodes.pop()
                leaves = node.leaves if node.children else 1
                saved = node.saved + (node.convs - 1) * node.words
                if nodes:
                    above = nodes[-1]
                    above.children += 1
                    above.leaves += leaves
                    above.saved += saved
                rows.append({"kind": LOOKUP, "conv_id": node.least, "depth": node.depth, "n_convs": node.convs,
                             "n_children": node.children, "n_leaves": leaves, "saved_tokens": saved, "key": node.key,
                             "parent_key": nodes[-1].key if nodes else None})

        schema = pa.schema(FIELDS)
        for batch in batches:
            for p in batch.to_pylist():
                depth = p["depth"]
                if depth >= len(nodes) or nodes[depth].turn != p["turn"]:
                    close(depth)
                    nodes.append(_Node(depth, p["turn"], p["key"], p["words"], True, 0))
                node = nodes[depth]
                node.least = min(node.least, p["conv_id"]) if node.convs else p["conv_id"]
                node.convs += p["n_convs"]
                node.children += p["n_children"]
                node.leaves += p["n_leaves"]
                node.saved += p["saved_tokens"]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        close(0)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return pieces.coalesce(1).sortWithinPartitions("part", "place").mapInArrow(run, SCHEMA)


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """(key, hashed): the digest of the ids of each key, in order, read one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hashed.digest()], pa.binary())],
                                              ["key", "hashed"])

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        yield row()
                    key, hashed = k, hashlib.sha256(str(c).encode())
                else:
                    hashed.update(f",{c}".encode())
        if key is not None:
            yield row()

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, hashed binary")


def trie(convs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every node of the prefix trie of ``convs`` (conv_id, turns), as ``turns`` gives them.

    Columns: conv_id (the least member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256, each as in the contract of op11.

    Conversations are dealt by range of (turns, id), so that a shard is a piece of the trie in
    depth-first order and a group of equal conversations or a common first turn spreads over as many
    shards as it fills. Within a shard blocks of bitmaps are descended one after another. Only nodes on
    the way to a shard's first or last conversation can be shared with other shards: their pieces
    are put together afterwards, two paths for each shard. Ids of the conversations that end in such a
    node, or in one where very many do, are sorted and hashed one by one: a SHA-256 can't be
    computed in parts, but nothing is gathered for it. A row holds one conversation's turns,
    20 bytes each, whatever their texts.
    """
    out = staged(_shards(convs, limits), "trie")
    shared = staged(_joined(out.filter(F.col("kind") == PIECE)), "trie-shared")
    parents = (out.filter(F.col("kind") == PARENT).select("key", "conv_id")
               .unionByName(shared.select("key", "conv_id"))
               .select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_id")))
    ends = _hashed_ends(out.filter(F.col("kind") == END).select("key", "conv_id"))
    none = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    lookup = (out.filter(F.col("kind") == LOOKUP).unionByName(shared)
              .join(parents, "parent_key", "left")
              .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_id")))
    known = lookup.filter("ends IS NOT NULL").select(*NODE, "ends")
    streamed = (lookup.filter("ends IS NULL").drop("ends").join(ends, "key", "left")
                .select(*NODE, F.coalesce("hashed", none).alias("ends")))
    done = out.filter(F.col("kind") == DONE).select(*NODE, "ends")
    return done.unionByName(known).unionByName(streamed).select(*NODE, F.lower(F.hex("ends")).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The trie of the conversations as they are.

    Turns are ordered by turn, null first; rows with equal turn by a hash of role and text, equal rows
    each count. Null role and text are empty. Rows with a null conv_id belong to no conversation.
    No rows give no nodes; further columns are not read."""
    return trie(staged(turns(conversations), "turns"), limits)


def rebuilt_trie(conversations: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The trie of the conversations rebuilt with the heads of every twentieth one, see op11."""
    convs = staged(turns(conversations), "turns")
    c = F.col("conv_id")
    return trie(staged(rebuilt(convs, c - c % 20, (F.crc32(c.cast("string").cast("binary")) % 4).cast("int"), 3), "rebuilt"), limits)
