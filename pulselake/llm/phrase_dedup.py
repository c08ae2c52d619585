"""Recurring passages of words, located by sharded Aho-Corasick automata."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulselake.llm.repeats import Removals, Units, equal_contexts, spans_of, without_repeats
from pulselake.llm.vectorized import BLANK, hash_words, words

WORDS_AT_ONCE = 1 << 18  # bytes of the contexts that one automaton serves, or one anchor's if they are more
GRAM = 5


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple:
    starts, ends, first = words(data, offsets, ~BLANK)
    return hash_words(data, starts, ends), first, starts, ends


def _joined(raw: bytes, starts: np.ndarray, ends: np.ndarray, a: int, b: int) -> bytes:
    return b" ".join([raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())])


def confirmed(passages: list[tuple[tuple[int, ...], int, int]], window: int) -> dict[tuple, int]:
    """The windows that are found in several documents, with the least id; passages are (words, least id, greatest id)."""
    least: dict[tuple, int] = {}
    several: set[tuple] = set()
    for words_of, low, high in passages:
        for i in range(len(words_of) - window + 1):
            w = words_of[i:i + window]
            before = least.setdefault(w, low)
            if before != low or low != high:
                several.add(w)
                if low < before:
                    least[w] = low
    return {w: least[w] for w in several}


def _compare(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        out = Removals()
        for part in equal_contexts(batches, WORDS_AT_ONCE):
            whole, number, passages, places = [], {}, [], []
            for group in part:
                for context, where in group:
                    if context is None:
                        whole.extend((key, start, stop) for start, stop, key in where)
                        continue
                    where.sort()
                    ids = tuple([number.setdefault(w, len(number)) for w in context.split()])
                    passages.append((ids, where[0][0], where[-1][0]))
                    places.append(where)
            if whole:
                out.add(*zip(*whole))
            phrases = confirmed(passages, window)
            if phrases:
                shard = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
                for phrase, least in phrases.items():
                    shard.add_word(phrase, least)
                shard.make_automaton()
                owner, offset = [], []
                keys, starts = [], []
                for (ids, _, high), where in zip(passages, places):
                    hits = [(end - window + 1, least) for end, least in shard.iter(ids) if least < high]
                    for i, _, start, key in where if hits else ():
                        mine = [at for at, least in hits if least < i]
                        owner.extend([len(keys)] * len(mine))
                        offset.extend(mine)
                        keys.append(key)
                        starts.append(start)
                if owner:
                    at, low, high = spans_of(np.array(owner), np.array(offset), window)
                    keys, starts = np.array(keys, np.int64), np.array(starts, np.int64)
                    out.add(keys[at], starts[at] + low, starts[at] + high)
            yield from out.rows()
        yield from out.rows(last=True)
    return run


def remove_repeated_phrases(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept) per row of ``docs``; units are words.

    Words are what blanks part, unchanged. A word goes if ``window`` consecutive words cover
    it that also start in a document with a smaller doc_id, judged on the input; kept joins the
    others by single spaces. Passages that recur are confirmed by comparing their words, each
    shard compiles its passages to an automaton and streams through it all stretches
    of the corpus in which one can occur. Null text has no words, a null id is the least.
    """
    kind = Units(window, min(GRAM, window), _words, _joined, within=False)
    return without_repeats(docs, kind, _compare(window), b" ", "string")
