import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulselake.llm import lexical_search
from pulselake.llm.queries import op12_lexical_search
from tests.llm.frames import UPPER, documents, odd_texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(rows, items, most=10):
    docs = [(i, terms(t)) for i, t in rows]
    n, length = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    counted = [(i, Counter(w), 25 + (75 * len(w) * n) // length) for i, w in docs if w]
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        found = []
        for i, c, m in counted:
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, k in Counter(terms(text)).items() if t in c)
            if s:
                found.append((-s, i is not None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(found)[:most])]
    return sorted(out, key=str)


def item_table(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, rank int")


ITEMS = [(10, "The of AND go No 10"), (9, "zz zz A1 never"), (11, None), (12, ""), (None, "tió ß"), (14, "a"), (14, "a"),
         (14, "ab new")]


@pytest.mark.parametrize("entries", [500_000, 4])
def test_search_equals_scoring_all(spark, monkeypatch, entries):
    monkeypatch.setattr(lexical_search, "ENTRIES", entries)
    rows = odd_texts(11, n=120)
    got = lexical_search.search(documents(spark, rows), item_table(spark, ITEMS))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, ITEMS)


def test_many_ties_and_a_hot_group(spark):
    rows = [(i, "the same words in all") for i in range(3000)] + [(5000 + i, f"other words {i}") for i in range(500)]
    items = [(1, "same words"), (2, "other 17"), (3, "in")]
    got = lexical_search.search(documents(spark, rows), item_table(spark, items))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, items)


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b")]), item_table(spark, [(1, "a")])
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(documents(spark, [(1, None), (2, "")]), items).count() == 0


def test_no_bound_is_below_a_score(spark):
    r = random.Random(2)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.7))}" for _ in range(int(r.paretovariate(0.5)) % 4000))) for i in range(400)]
    index = lexical_search.build_index(documents(spark, rows))
    items = [Counter(f"w{int(r.paretovariate(0.7))}" for _ in range(20)) for _ in range(9)]
    df = Counter(t for _, x in rows for t in set(terms(x)))

    def hashed(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(lexical_search.hash_words(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])

    queries = lexical_search._Queries(
        [[(t.encode(), hashed(t), k, lexical_search.weight(index.documents, df[t])) for t, k in c.items()] for c in items],
        index.documents, index.length)
    counts = {i: Counter(t.encode() for t in terms(x)) for i, x in rows}
    seen, tight = 0, 0
    (_, names, table), = queries.parts()
    for block in index.blocks.collect():
        bound = lexical_search.bounds(block.bits, bytes(block.slices), queries.gains(block.n, block.top), names, table)
        for j, i in enumerate(block.ids):
            m = lexical_search.length_part(sum(counts[i].values()), index.documents, index.length)
            for q in range(len(items)):
                score = queries.score(q, counts[i], m)
                assert bound[q, j] >= score
                seen += score > 0
                tight += score > 0 and bound[q, j] <= 1.5 * score
    assert seen == sum(1 for i, x in rows for q in range(len(items)) if any(t.encode() in counts[i] for t in items[q]))
    assert tight > 0.8 * seen


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    read = {t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(k, "text").collect()]
            for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    got = op12_lexical_search(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == plain(read["documents"], read["benchmark"])
