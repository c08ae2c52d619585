import random
from collections import Counter

import numpy as np
import pytest

from pulselake.llm import cap_filters, hyperminhash
from pulselake.llm.components import components
from tests.llm.frames import UPPER, blank_words, documents, odd_texts


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(i, i + 1) for i in range(100, 115)] + [(200, i) for i in range(201, 230)]
    links += [(r.randrange(80), r.randrange(80)) for _ in range(40)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links if p[0] != p[1] for x in p}
    assert got == classes(nodes, [p for p in links if p[0] != p[1]])


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def shingles(text, size):
    w = blank_words((text or "").translate(UPPER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block", [512, 2])
@pytest.mark.parametrize("seed,size", [(21, 2), (22, 3)])
def test_documents(spark, monkeypatch, seed, size, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = odd_texts(seed, n=80, words=60)
    sets = {(-(1 << 63) if i is None else i, t): shingles(t, size) for i, t in rows}
    nodes = sorted(sets, key=lambda k: (k[0], k[1] or ""))
    number = {n: k for k, n in enumerate(nodes)}
    links = [(number[a], number[b]) for a in nodes for b in nodes if number[a] < number[b] and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = {n: nodes[c][0] for n, c in zip(nodes, classes(range(len(nodes)), links).values())}
    want = Counter()
    for i, t in rows:
        k = -(1 << 63) if i is None else i, t
        c = least[k]
        want[i, len(sets[k]), None if c == -(1 << 63) else c, k[0] == c] += 1
    got = hyperminhash.report(documents(spark, rows), size, 80).collect()
    assert Counter(map(tuple, got)) == want
    kept = hyperminhash.one_of_each(documents(spark, rows), size, 80)
    assert kept.columns == documents(spark, rows).columns
    assert len(kept.collect()) == len(set(classes(range(len(nodes)), links).values()))


@pytest.mark.parametrize("sides", [1, 2])
@pytest.mark.parametrize("seed", range(4))
def test_a_block_puts_out_what_joins_its_components(seed, sides):
    r = np.random.default_rng(seed)
    centre = [r.choice(1 << 40, 60, replace=False).astype(np.uint64) for _ in range(3)]
    sets = [np.unique(np.concatenate([r.permutation(centre[k % 3])[:r.integers(53, 60)], r.integers(0, 1 << 40, r.integers(0, 5)).astype(np.uint64)]))
            for k in range(70)]
    side = np.zeros(70, int) if sides == 1 else r.integers(1, 3, 70)
    links = [(i, j) for i in range(70) for j in range(i) if (sides == 1 or side[i] != side[j])
             and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    before = [(k, k % 7) for k in range(0, 70, 7)]
    component = np.array([(-k, c) for k, c in classes(range(70), before).items()], "i8,i8")
    component["f0"] = -component["f1"]
    got = hyperminhash.spanning(sets, component, side, 80)
    known = list(enumerate(component["f1"].tolist()))
    assert {(max(p), min(p)) for p in got} <= set(links) and len(links) > 100
    assert classes(range(70), known + got) == classes(range(70), known + links)
    assert len(got) == len(set(classes(range(70), known).values())) - len(set(classes(range(70), known + links).values()))
    assert hyperminhash.spanning([np.array([3, 4], np.uint64)] * 2, np.array([(1, 1), (1, 1)], "i8,i8"), np.zeros(2, int), 80) == []


def test_rows_grow_with_a_crowd_and_not_with_its_pairs(spark, monkeypatch):
    """Texts of one origin, most of them far enough from one another to be no links, few by estimate alone."""
    r = random.Random(8)
    origin = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(f"x{i}y{k}" if r.random() < 0.045 else w for k, w in enumerate(origin))) for i in range(240)]
    made, staged = [], hyperminhash.staged

    def counted(df, label):
        out = staged(df, label)
        made.append((out.count(), label))
        return out
    monkeypatch.setattr(hyperminhash, "staged", counted)
    got = hyperminhash.report(documents(spark, rows), 2, 80).collect()
    bands = hyperminhash.BANDED // hyperminhash.BAND
    assert max(n for n, _ in made) <= bands * len(rows)
    assert max(n for n, label in made if label in ("between", "rest", "verified")) < 4 * len(rows)
    sets = [shingles(t, 2) for _, t in rows]
    links = [(a, b) for a in range(240) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {x.doc_id: x.component_id for x in got} == classes(range(240), links)


def test_estimates_are_near_the_truth():
    r = np.random.default_rng(1)
    for share in (0.3, 0.8, 0.95):
        both = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
        a, b = both[:int(4000 * (1 + share) / 2)], both[-int(4000 * (1 + share) / 2):]
        x, y = hyperminhash.registers(a), hyperminhash.registers(b)
        assert abs(hyperminhash.estimate(x, y, np.array(len(a)), np.array(len(b))) - share) < 0.2
    x, y = (hyperminhash.registers(r.integers(0, 1 << 63, 3000, dtype=np.uint64)) for _ in range(2))
    assert hyperminhash.estimate(x, y, np.array(3000), np.array(3000)) < 0.1


@pytest.mark.parametrize("block", [512, 3])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    r = np.random.default_rng(4)
    rows = []
    for i in range(160):
        label = [1, 2, None, 1][i % 4]
        if i % 3 and rows and rows[-1][1]:
            v = np.array(rows[-1][1], float) + r.normal(0, 0.02, 16) * (i % 2)
        else:
            v = r.normal(0, 1, 16)
        rows.append((i, [float(x) for x in v.astype(np.float32)], label))
    one = [1.0] * 16
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, one[:15] + [float("nan")], 1), (504, one[:15] + [None], 1),
             (505, one, 1), (506, [2.0] * 16, 1), (507, one, 2), (508, one[:8], 1), (509, [3.0] * 8, 1), (510, one[:15] + [float("inf")], 1)]
    schema = "vec_id long, embedding array<float>, label int, filter string, node string, links string, copies string"
    df = spark.createDataFrame([(*x, None, "x", None, "x") for x in rows], schema)
    ok = {i: np.array(v) / np.linalg.norm(v) for i, v, lab in rows
          if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: lab for i, _, lab in rows}
    links = [(a, b) for a in ok for b in ok if a != b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.98]
    n, c = Counter(a for a, _ in links), classes([i for i, _, _ in rows], links)
    want = sorted((i, n[i], c[i], c[i] == i) for i, _, _ in rows)
    assert sorted(map(tuple, cap_filters.near_duplicates(df).collect())) == want
    assert len(links) > 50 and cap_filters.near_duplicates(df.limit(0)).collect() == []
