"""Token counts; huge documents are encoded in overlapping chunks and spliced."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CHUNK, OVERLAP = 1 << 16, 256  # characters


class Vocabulary:
    """A byte-level BPE vocabulary: ids of a text and the bytes each id stands for.

    The .json file is read by tokenizers. If the same vocabulary is there as ranks, texts of
    characters below U+0250 without special strings go through tiktoken, which is several times
    faster; the Unicode classes of the pattern are alike in both libraries there (tested).
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        special = {t["id"]: t["content"] for t in config["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, special.values()))) if special else None
        self.unusual = re.compile("[^\x00-ɏ]")
        # A byte-level token has one character for each byte.
        lengths = {i: len(t) for t, i in config["model"]["vocab"].items()}
        lengths.update((i, len(t.encode())) for i, t in special.items())
        self.lengths = np.zeros(max(lengths) + 1, np.int64)
        self.lengths[list(lengths)] = list(lengths.values())
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not self.unusual.search(text) and not (self.special and self.special.search(text)):
            return self.fast.encode_ordinary(text)
        return self.full.encode(text, add_special_tokens=False).ids

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes."""
        return np.cumsum(self.lengths[self.ids(text)])


# Places where a token ends whatever stands around, as no match of the byte-level pattern goes on there:
# before a blank behind anything else, and before punctuation behind a letter of any script (never the
# other way round: punctuation may begin a contraction). Inside a special string the encodings disagree.
STABLE = regex.compile(r"(?<=[\p{L}\p{N}\p{P}\p{S}])[ \n]|(?<=\p{L})[!-/:-@\[-`{-~\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1B\uFF1F"
                       r"\u060C\u061B\u061F\u0964\u2026]")


def _reach(text: str, start: int, chunk: int, overlap: int) -> int:
    """Where a chunk from ``start`` ends: with a stable place among its last ``overlap`` characters. It is
    longer than ``chunk`` only where there is none in reach, as then no cut can be proven."""
    if start + chunk >= len(text):
        return len(text)
    place = STABLE.search(text, start + chunk - overlap + 2)
    return min(len(text), max(start + chunk, place.start() + overlap // 2 + 2)) if place else len(text)


def count(text: str, ends: Callable[[str], np.ndarray], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of ``text``, of which no more than about a chunk is encoded at once.

    Neighbouring chunks overlap. They are spliced at a stable character boundary in the
    overlap that both encodings have as a token boundary: what is left of it is counted in
    the left chunk, the rest in the right one. Without such a boundary the overlap doubles,
    in the end to both chunks as one. A chunk ends behind a stable place, so that this is rare: text of any
    script is encoded little more than once.
    """
    overlap = max(overlap, 4)
    if len(text) <= chunk:
        return len(ends(text))
    total, start, stop = 0, 0, _reach(text, 0, chunk, overlap)
    left, skip = ends(text[:stop]), 0  # skip: bytes of the chunk that are counted already
    while stop < len(text):
        wide, cut, far = overlap, None, stop
        while cut is None and stop - wide > start:
            begin = stop - wide
            wide *= 2
            places = [m.start() for m in STABLE.finditer(text, begin + 1, stop - 1)]
            if not places:
                continue
            far = _reach(text, begin, max(chunk, 2 * (stop - begin)), overlap)
            right = ends(text[begin:far])
            base = len(text[start:begin].encode())
            for place in places:
                at = len(text[begin:place].encode())
                if base + at > skip and _is_end(left, base + at) and _is_end(right, at):
                    cut = at
                    break
        if cut is None:  # no boundary in the whole left chunk: it goes on, twice as long
            stop = _reach(text, start, 2 * (stop - start), overlap)
            left = ends(text[start:stop])
            continue
        total += int(np.searchsorted(left, base + cut, "right") - np.searchsorted(left, skip, "right"))
        left, start, stop, skip = right, begin, far, cut
    return total + int(len(left) - np.searchsorted(left, skip, "right"))


def _is_end(ends: np.ndarray, at: int) -> bool:
    i = np.searchsorted(ends, at)
    return i < len(ends) and ends[i] == at


@lru_cache(maxsize=2)
def vocabulary(path: str, ranks_path: str | None, pattern: str | None) -> Vocabulary:
    return Vocabulary(path, ranks_path, pattern)


def count_tokens(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs``, in one pass without a shuffle.

    ``path`` names the vocabulary's .json file, ``ranks_path`` and ``pattern`` the same one
    for the fast path; executors read them from their own installation. A null text counts as
    empty. Special strings in a text are one token, as the library has it by default.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path, ranks_path, pattern)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                s = text.as_py() or ""
                sizes.append(len(s.encode()))
                tokens.append(count(s, voc.ends, chunk, overlap))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long")
