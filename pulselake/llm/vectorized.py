"""Words and hashes of many texts at once, as numpy arrays over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 4 << 20
LONG_WORD = 48
BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LETTER = np.zeros(256, bool)  # digits, letters, and all bytes beyond ASCII
LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def blocks(batches: Iterator[pa.RecordBatch], column: int,
           most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with the texts of a few megabytes at a time; null is empty.

    A single text above ``most`` bytes is a block of its own.
    """
    for batch in batches:
        text = batch.column(column).cast(pa.binary()).fill_null(b"")
        offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, 4 * text.offset).astype(np.int64)
        data = text.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): where the words lie, and the number of the first word of each text.

    ``inside`` marks the byte values words are made of. first has an entry more than texts.
    """
    within = np.zeros(len(data) + 2, bool)
    within[1:-1] = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(within[1:] & (~within[:-1] | edge))
    ends = np.flatnonzero(within[:-1] & (~within[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    length = ends - starts
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    s, n = starts[order], length[order]
    h = n.astype(np.uint64)
    at_least = np.searchsorted(-np.minimum(n, LONG_WORD + 1), -np.arange(1, LONG_WORD + 2), "right")
    for j in range(LONG_WORD):
        m = at_least[j]
        if not m:
            break
        h[:m] = h[:m] * BASE + _TABLE[data[s[:m] + j]]
    out = np.empty(len(h), np.uint64)
    out[order] = mix(h)
    for i in order[:at_least[LONG_WORD]]:
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def byte_units(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each byte."""
    return _TABLE[data]


def gram_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` units from each place on; len(units) - size + 1 of them.

    Two overlapping runs of a power of two units determine the whole.
    """
    if len(units) < size:
        return np.zeros(0, np.uint64)
    h, width, power = units.astype(np.uint64), 1, int(BASE)
    while 2 * width <= size:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % (1 << 64), 2 * width
    if width < size:
        h = mix(h[:len(h) - (size - width)]) + h[size - width:] * np.uint64(power)
    return mix(h)
