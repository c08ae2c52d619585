"""The mix keeps all it can and holds the exact weights over the whole run."""

import random
from collections import Counter
from fractions import Fraction

import pytest

from pulselake.llm.mixing import kept_counts, mix, mixed, schedule
from tests.llm.frames import documents


def plain_kept(counts, ceiling):
    """Rows of each source in the largest mix in which none has more than the ceiling, by trial."""
    for m in range(sum(counts.values()), 0, -1):
        some = {s: min(n, int(ceiling * m)) for s, n in counts.items()}
        if sum(some.values()) >= m:
            return some
    return dict(counts)  # none can hold it


def test_kept_counts_equal_trial():
    r = random.Random(8)
    for _ in range(200):
        counts = {i: r.choice([1, 3, r.randint(1, 12), r.randint(1, 200)]) for i in range(r.randint(1, 9))}
        ceiling = r.choice([Fraction(1, 3), Fraction(1, 2), Fraction(2, 5), Fraction(1, 7)])
        assert kept_counts(counts, float(ceiling)) == plain_kept(counts, ceiling)
    many = {**{i: 200_000 for i in range(20)}, "rare": 3, None: 1}
    assert kept_counts(many, 1 / 3) == many  # no source above the ceiling: no row is lost


@pytest.mark.parametrize("few", [3, 1])
def test_scarce_sources_do_not_end_the_mix(spark, few):
    sources = ["hot"] * 1500 + ["a"] * 400 + ["b"] * 301 + [None] * 5 + ["rare"] * few
    random.Random(2).shuffle(sources)
    docs = documents(spark, [(i, f"text {i}") for i in range(len(sources))], sources)
    out = mix(docs, ceiling=1 / 3, block=8, frame=10, ranges=8).collect()
    want = plain_kept(Counter(sources), Fraction(1, 3))
    assert Counter(r["source"] for r in out if r["in_mix"]) == want and want[None] == 5 and want["rare"] == few
    assert sorted(r["position"] for r in out) == list(range(len(sources)))
    assert sorted(r["position"] for r in out if r["in_mix"]) == list(range(sum(want.values())))
    left = mixed(docs, ceiling=1 / 3, block=8, frame=10, ranges=8).collect()
    assert {r["doc_id"] for r in left} == {r["doc_id"] for r in out if r["in_mix"]}


def test_fewer_sources_than_can_hold_the_ceiling_keep_all(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(203)], ["a"] * 200 + ["b"] * 3)
    assert mixed(docs, ceiling=1 / 3, frame=5, ranges=4).count() == 203


def plain_release_and_deadline(k, w):
    return k * w.denominator // w.numerator, -(-(k + 1) * w.denominator // w.numerator)


def deviation(lines, sources, total, block):
    """The most that any source is from its exact weight at any row of the mix, in blocks."""
    served, most = [0] * len(sources), Fraction(0)
    n = 0
    for number, k, at, taken, _, release, due in sorted((x for x in lines if x[3]), key=lambda x: x[2]):
        assert at == n and served[number] == k * block
        assert (release, due) == plain_release_and_deadline(k, Fraction(*sources[number][3:]))
        for _ in range(taken):
            n, served[number] = n + 1, served[number] + 1
            most = max(most, *(abs(served[i] - Fraction(n * s[3], s[4])) for i, s in enumerate(sources)))
    assert n == total
    return most / block


@pytest.mark.parametrize("counts,block", [
    ([14_950, 60_000, 24_975, 75], 4), ([1] * 40 + [3] * 30 + [700, 2000, 1999], 8), ([7, 5, 2003, 990, 1010], 8), ([5], 8)])
def test_less_than_one_block_from_the_exact_weights(counts, block):
    total = sum(counts)
    sources = [(i, n, n, Fraction(n, total).numerator, Fraction(n, total).denominator) for i, n in enumerate(counts)]
    lines = list(schedule(sources, total, block))
    assert deviation(lines, sources, total, block) < 1
    assert sum(x[3] for x in lines) == total and len(lines) == sum(-(-n // block) for n in counts)


@pytest.mark.parametrize("seed", range(4))
def test_given_weights_hold_to_the_end(seed):
    r = random.Random(seed)
    weights = [Fraction(r.random()) ** r.choice([1, 4]) for _ in range(r.randint(2, 12))]
    exact = [w / sum(weights) for w in weights]
    counts = [r.randint(1, 900) for _ in exact]
    total = int(min(n / w for n, w in zip(counts, exact)))
    sources = [(i, n, n, w.numerator, w.denominator) for i, (n, w) in enumerate(zip(counts, exact))]
    lines = list(schedule(sources, total, 8))
    assert deviation(lines, sources, total, 8) < 1
    places = [p for _, k, at, taken, rest, _, _ in lines for p in range(at or 0, (at or 0) + taken)]
    beyond = sum(n for n in counts) - total
    assert sorted(places) == list(range(total)) and (beyond == 0 or max(x[4] for x in lines if x[4] is not None) < total + beyond)


def test_many_frames_of_a_table(spark):
    sources = ["big"] * 1200 + ["mid"] * 299 + ["rare"] * 7
    random.Random(4).shuffle(sources)
    docs = documents(spark, [(i, f"text {i}") for i in range(len(sources))], sources)
    weights = {"big": 0.8, "mid": 0.1955, "rare": 0.0045}
    out = mix(docs, weights=weights, block=2, frame=20, ranges=8).collect()
    taken = sorted((r for r in out if r["in_mix"]), key=lambda r: r["position"])
    assert [r["position"] for r in taken] == list(range(1500))
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    served = Counter()
    for n, r in enumerate(taken, 1):
        served[r["source"]] += 1
        assert (r["release"], r["deadline"]) == plain_release_and_deadline(r["block"], exact[r["source"]])
        assert all(abs(served[s] - exact[s] * n) < 2 for s in exact)
