import re

import pytest

from pulselake.llm import decontamination, line_dedup
from tests.llm.frames import UPPER, documents, odd_texts


def keys(text):
    lines = (text or "").split("\n")
    return [(x, re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate(UPPER)) for x in lines]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [2000, 1])
def test_lines(spark, monkeypatch, keep, hot):
    monkeypatch.setattr(line_dedup, "MIN_HOT_LINES", hot)
    rows = odd_texts(7) + [(700 + i, f" Same\tLINE \n{i}\nSAME\tline\nÄ\n") for i in range(30)]
    out = line_dedup.dedup_lines(documents(spark, rows), min_docs=4, keep=keep).collect()
    docs, firsts = {}, {}
    for i, t in rows:
        for p, (_, k) in enumerate(keys(t)):
            docs.setdefault(k, set()).add(i)
    def least(i):
        return (i is not None, i or 0)
    many = {k for k, d in docs.items() if k and len(d) >= 4}
    for i, t in sorted(set(rows), key=lambda x: least(x[0])):
        for p, (_, k) in enumerate(keys(t)):
            firsts.setdefault(k, (i, t, p))
    want = []
    for i, t in rows:
        lines = keys(t)
        stay = [x for p, (x, k) in enumerate(lines) if k not in many or (keep == "first" and firsts[k] == (i, t, p))]
        want.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    if keep == "first":  # which of several texts of one id is first is the fingerprint's choice
        want = [w for w in want if w[0] not in (904,)]
        out = [r for r in out if r[0] not in (904,)]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def plain_hits(text, items, size):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    hit, found = set(), set()
    for item, t in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
        n = min(size, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [(10, "The of AND go No 10"), (9, "x y zz"), (11, None), (12, ""), (13, "zz"), (14, "the of and tió ß a1 zz"), (14, "No"),
         (None, "never said")]


@pytest.mark.parametrize("windows,pairs", [(200_000, 50_000), (0, 0)])
@pytest.mark.parametrize("size", [3, 10])
def test_benchmark(spark, monkeypatch, size, windows, pairs):
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_WINDOWS", windows)
    monkeypatch.setattr(decontamination, "MAX_LISTED_PAIRS", pairs)
    rows = odd_texts(9)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r[0], r[1], r[2], r[3]) for r in decontamination.report(documents(spark, rows), bench, size).collect()]
    want = [(i, *plain_hits(t, ITEMS, size)) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    left = decontamination.remove_contaminated(documents(spark, rows), bench, size)
    assert left.columns == documents(spark, rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        ((i, t) for i, t in rows if not plain_hits(t, ITEMS, size)[1]), key=str)


def test_nothing_there(spark):
    docs, bench = documents(spark, [(1, "a b")]), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.report(docs.limit(0), bench).collect() == []
    assert [r["n_hit"] for r in decontamination.report(docs, bench.limit(0)).collect()] == [0]
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []
