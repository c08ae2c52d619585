"""Secrets in whole texts, by one combined automaton of all rules."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.automaton import SEPARATOR, Automaton, compiled
from pulselake.llm.vectorized import blocks

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@dataclass(frozen=True)
class Rule:
    """Matches of ``head`` and ``body``, leftmost, longest and not overlapping; those whose body
    has fewer than ``least`` bytes are dropped after they have been taken out of the text. ``fold``:
    letters of the head in either case."""

    kind: str
    head: str
    body: str
    least: int = 0
    fold: bool = False

    @property
    def regex(self) -> str:
        return f"(?i:{self.head}){self.body}" if self.fold else self.head + self.body


# The rules of the report.
BASE = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 8, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 12),
    # A shorter run of hexadecimal digits never holds a longer one, so its length may be in the expression.
    Rule("hex", r"", r"[0-9a-f]{32,}"),
)
# Public formats of tokens and keys.
MORE = (
    Rule("github", r"gh[oprsu]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", 8),
    Rule("private_key", r"-----BEGIN\x20", r"([A-Z0-9]+\x20)*PRIVATE\x20KEY-----"),
)


@cache
def _automata(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton], list[Automaton]]:
    """(where matches of which rules begin, reading backwards; each rule; each rule's head)."""
    return (compiled([(r.regex, False) for r in rules], backwards=True, anywhere=True),
            [compiled([(r.regex, False)]) for r in rules], [compiled([(r.head, r.fold)]) for r in rules])


def find(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, rule, end), in bytes, in order.

    One pass over the bytes of all texts, backwards, gives the places where matches of each
    rule begin. From the first place on the rule's own automaton finds the longest match; the next
    one begins behind it.
    """
    begins, whole, heads = _automata(rules)
    marked = np.insert(data, offsets[1:], SEPARATOR)
    found = begins.accepts[begins.states(marked[::-1])][::-1]
    hits = np.flatnonzero(found)
    texts = offsets[:-1] + np.arange(len(offsets) - 1)  # where each text begins among the separators
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    raw = marked.tobytes() if len(hits) else b""
    for k, rule in enumerate(rules):
        starts = hits[(found[hits] >> k) & 1 == 1]
        at = 0
        while at < len(starts):
            start = int(starts[at])
            end = whole[k].ends(raw, start)
            if end - heads[k].ends(raw, start) >= rule.least:
                text = int(np.searchsorted(texts, start, "right")) - 1
                out[text].append((start - int(texts[text]), k, end - int(texts[text])))
            at = int(np.searchsorted(starts, max(end, start + 1)))
    return [sorted(spans) for spans in out]


def _in_characters(text: np.ndarray, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points: bytes that continue a character do not count."""
    before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return [(int(before[a]), k, int(before[b])) for a, k, b in spans]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, spans): for each row the matches of all rules in its whole text.

    spans is an array of (kind, start, end) by start, then by the order of ``rules``; places are
    code points, the end is exclusive. Matches of one rule do not overlap, those of
    different rules may. A null or empty text has none; a null id stays null, repeated rows each have
    their row, further columns are left out, and a table without rows gives none. Texts are scanned a
    few megabytes at a time, a longer one by itself: memory is some tens of bytes for each byte of the longest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, 1):
            spans = find(data, offsets, rules)
            listed = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in
                       _in_characters(data[offsets[i]:offsets[i + 1]], s)] if s else [] for i, s in enumerate(spans)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(listed, pa.list_(SPAN))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; spans that touch or overlap by the
    kind of the first. Other columns and null texts stay."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, place):
            texts = []
            for i, spans in enumerate(find(data, offsets, rules)):
                text, parts, at, upto = data[offsets[i]:offsets[i + 1]].tobytes(), [], 0, -1
                for a, k, b in spans:
                    if a > upto:
                        parts += [text[at:a], f"[{rules[k].kind}]".encode()]
                    at = upto = max(upto, b)
                texts.append(b"".join([*parts, text[at:]]).decode())
            was = rows.column(place)
            new = pa.array(texts, pa.string()) if not was.null_count else pa.array(
                [None if missing else t for t, missing in zip(texts, was.is_null().to_pylist())], pa.string())
            columns = [new if j == place else rows.column(j) for j in range(rows.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): the digest of ``scan``."""
    found = scan(docs)
    kinds = [r.kind for r in BASE]

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *[of(kind) for kind in kinds],
        F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
