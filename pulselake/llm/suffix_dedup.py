"""Repeated byte strings, by suffix arrays over Lyndon groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulselake.llm.gsaca import suffix_array
from pulselake.llm.repeats import Removals, Units, equal_contexts, spans_of, without_repeats
from pulselake.llm.vectorized import byte_units, gram_hashes

TEXT_AT_ONCE = 1 << 14  # bytes of one suffix array, or one anchor's contexts if they are more
GRAM = 32


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple:
    return byte_units(data), offsets, None, None


def _slice(raw: bytes, _, __, a: int, b: int) -> bytes:
    return raw[a:b]


def _recurring(contexts: list[bytes], window: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The contexts that hold a window whose hash is also another one's, and from where to where such
    windows reach in each."""
    size = np.array([len(c) for c in contexts])
    begin = np.cumsum(size) - size
    hashes = gram_hashes(byte_units(np.frombuffer(b"".join(contexts), np.uint8)), window)
    whose = np.repeat(np.arange(len(contexts)), size)[:len(hashes)]
    inside = np.flatnonzero(np.arange(len(hashes)) + window <= (begin + size)[whose])
    _, back, count = np.unique(hashes[inside], return_inverse=True, return_counts=True)
    at = inside[count[back] > 1]
    first = np.flatnonzero(np.diff(whose[at], prepend=-1))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    which = whose[at[first]]
    return which, (at[first] - begin[which], at[last] - begin[which] + window) if len(at) else (at, at)


def repeated(contexts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, context, offset) of each window that another one equals, class by class.

    What of the contexts lies between windows whose hash recurs forms one text. In its suffix array
    equal windows are neighbours, whatever comes between the contexts.
    """
    which, skipped = _recurring(contexts, window)
    if not len(which):
        return (np.zeros(0, np.int64),) * 3
    contexts = [contexts[i][a:b] for i, a, b in zip(which, *skipped)]
    text = b"\0".join(contexts)
    size = np.array([len(c) for c in contexts])
    begin = np.cumsum(size + 1) - size - 1
    whose = np.repeat(np.arange(len(contexts)), size + 1)[:len(text)]
    inside = np.arange(len(text)) + window <= (begin + size)[whose]
    order = np.array(suffix_array(text), np.int64)
    order = order[inside[order]]
    hashes = gram_hashes(byte_units(np.frombuffer(text, np.uint8)), window)[order]
    alike = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
    a, b = order[alike - 1].tolist(), order[alike].tolist()
    same = np.zeros(len(order), bool)
    same[alike] = [text[i:i + window] == text[j:j + window] for i, j in zip(a, b)]
    several = same | np.concatenate([same[1:], [False]]) if len(order) else same
    kind, at = np.cumsum(~same)[several], order[several]
    return kind, which[whose[at]], at - begin[whose[at]] + skipped[0][whose[at]]


def _compare(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Removals()
        for part in equal_contexts(batches, TEXT_AT_ONCE):
            whole, contexts, places = [], [], []
            for group in part:
                for context, where in group:
                    if context is None:
                        whole.extend((key, start, stop) for start, stop, key in where)
                        continue
                    where.sort()
                    first = where[0]
                    whole.extend((w[3], w[2], w[2] + len(context)) for w in where if w[:3] != first[:3])
                    if len(group) > 1:  # the only context of an anchor has no window twice
                        contexts.append(context)
                        places.append(first)
            if whole:
                out.add(*zip(*whole))
            if contexts:
                kind, context, offset = repeated(contexts, window)
                rank = np.empty(len(places), np.int64)
                ids = {d: i for i, d in enumerate(sorted({p[:2] for p in places}))}
                rank[:] = [ids[p[:2]] for p in places]
                start, key = (np.array([p[i] for p in places], np.int64) for i in (2, 3))
                # In each class the least place by document and position stays, and with
                # it contexts that hold that very place.
                document, at = rank[context], start[context] + offset
                order = np.lexsort((at, document, kind))
                kind, context, offset, document, at = (x[order] for x in (kind, context, offset, document, at))
                first = np.flatnonzero(np.diff(kind, prepend=-1))
                least = np.repeat(first, np.diff(np.concatenate([first, [len(kind)]])))
                gone = (document != document[least]) | (at != at[least])
                owner, low, high = spans_of(context[gone], offset[gone], window)
                out.add(key[owner], start[owner] + low, start[owner] + high)
            yield from out.rows()
        yield from out.rows(last=True)
    return run


def remove_repeated_bytes(docs: DataFrame, window: int = 100) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept) per row of ``docs``; units are UTF-8 bytes.

    A byte goes if a string of ``window`` bytes covers it that starts earlier too: in a smaller
    doc_id, or before in the same document. Matches stay within documents and are
    judged on the input. Rows with equal id order by their text's fingerprint; rows equal in both
    are one document. Null text is empty, a null id the least.
    """
    kind = Units(window, min(GRAM, window), _bytes, _slice, within=True, block=1 << 20)
    return without_repeats(docs, kind, _compare(window), b"", "binary")
