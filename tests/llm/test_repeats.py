import random

import pytest

from pulselake.llm import repeats
from pulselake.llm.gsaca import lyndon_groups, suffix_array
from pulselake.llm import suffix_dedup
from pulselake.llm.phrase_dedup import remove_repeated_phrases
from pulselake.llm.suffix_dedup import remove_repeated_bytes, repeated
from tests.llm.frames import blank_words, documents, odd_texts


@pytest.mark.parametrize("seed", range(200))
def test_suffix_array(seed):
    r = random.Random(seed)
    text = [r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.randint(0, 60))] + r.choice([[], [0], [0, 1, 0]])
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_groups_are_lyndon_prefixes():
    text = list(b"abracadabra banana")
    groups, prev = lyndon_groups(text)
    order = sorted(range(len(text)), key=lambda i: text[i:])
    rank = {p: k for k, p in enumerate(order)}

    def prefix(i):  # up to the next smaller suffix
        return text[i:next((j for j in range(i + 1, len(text)) if rank[j] < rank[i]), len(text))]
    assert [sorted({tuple(prefix(i)) for i in g}) for g in groups] == [[p] for p in sorted({tuple(prefix(i)) for i in range(len(text))})]
    assert all(p < i and p >= -1 for i, p in enumerate(prev))


def test_classes_of_equal_windows():
    contexts = [b"abcabcx", b"bcabc", b"zzzz", b"", b"ab"]
    by = {}
    for kind, k, o in zip(*repeated(contexts, 3)):
        by.setdefault(kind, []).append((k, o))
    got = sorted(sorted(c) for c in by.values())
    want = {}
    for k, c in enumerate(contexts):
        for o in range(len(c) - 2):
            want.setdefault(c[o:o + 3], []).append((k, o))
    assert got == sorted(sorted(v) for v in want.values() if len(v) > 1)


def least(i):
    return -(1 << 63) if i is None else i


def plain_bytes(rows, window):
    """Per (id, text): bytes, removed, runs, rest. Equal rows are one document; ties of the id differ by text."""
    starts = {}
    docs = {(least(i), t) for i, t in rows}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - window + 1):
            starts.setdefault(b[s:s + window], []).append((i, t, s))
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if any(j < i or (j == i and u == t and q < s) for j, u, q in starts[b[s:s + window]]):
                gone[s:s + window] = [True] * window
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, t] = len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)
    return out


def plain_words(rows, window):
    low = {}
    for i, t in rows:
        w = blank_words(t)
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            low[g] = min(low.get(g, least(i)), least(i))
    out = {}
    for i, t in rows:
        w = blank_words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if low[tuple(w[s:s + window])] < least(i):
                gone[s:s + window] = [True] * window
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[least(i), t] = len(w), sum(gone), runs, " ".join(x for x, g in zip(w, gone) if not g)
    return out


@pytest.mark.parametrize("hot", [1000, 2])
@pytest.mark.parametrize("seed,window", [(1, 30), (2, 12)])
def test_bytes(spark, monkeypatch, seed, window, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = odd_texts(seed)
    got = sorted((least(r[0]), *map(str, r[1:])) for r in remove_repeated_bytes(documents(spark, rows), window).collect())
    plain = plain_bytes(rows, window)
    assert got == sorted((least(i), *map(str, (n, m, k, b))) for i, t in rows for n, m, k, b in [plain[least(i), t]])


@pytest.mark.parametrize("hot", [1000, 2])
@pytest.mark.parametrize("seed,window", [(3, 5), (4, 3)])
def test_words(spark, monkeypatch, seed, window, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = odd_texts(seed)
    got = sorted((least(r[0]), *map(str, r[1:])) for r in remove_repeated_phrases(documents(spark, rows), window).collect())
    plain = plain_words(rows, window)
    assert got == sorted((least(i), *map(str, plain[least(i), t])) for i, t in rows)


def test_no_rows(spark):
    docs = documents(spark, [(1, "a b c")]).limit(0)
    assert remove_repeated_bytes(docs).collect() == remove_repeated_phrases(docs).collect() == []


def test_only_what_recurs_goes_into_a_suffix_array(monkeypatch):
    sorted_texts, whole = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda t: sorted_texts.append(bytes(t)) or whole(t))
    kind, context, offset = repeated([b"abcdefgh", b"xxcdefyy", b"ijklmnop", b"qr"], 3)
    assert sorted(zip(kind.tolist(), context.tolist(), offset.tolist())) == [(1, 0, 2), (1, 1, 2), (2, 0, 3), (2, 1, 3)]
    assert sorted_texts == [b"cdef\0cdef"]
    assert [len(x) for x in repeated([b"abcd", b"efgh"], 3)] == [0, 0, 0] and len(sorted_texts) == 1
