"""Mixing and sharding."""

from collections import Counter, defaultdict

import pytest

from pulselake.llm import ranges
from pulselake.llm.mixing import capped_shares, mix, mixed, pfair_frame, quotas
from pulselake.llm.sharding import shard
from tests.llm.frames import documents, odd_texts


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 2}, {"a": 1}, {"a": 97, "b": 1, None: 2}, {i: i + 1 for i in range(17)}])
def test_less_than_one_block_from_the_share(weights):
    frame = 200
    q = quotas(weights, frame)
    assert sum(q.values()) == frame
    plan = pfair_frame(q, frame)
    assert sorted(p[2] for p in plan) == list(range(frame))
    served = Counter()
    for s, k, slot, release, due in plan:
        assert release <= slot < due and k == served[s]
        served[s] += 1
        assert all(abs(served[x] - q[x] * (slot + 1) / frame) < 1 for x in q)


def test_capped_shares():
    shares = capped_shares({"a": 70, "b": 20, "c": 10}, 0.5)
    assert shares["a"] == 0.5 and abs(shares["b"] - 1 / 3) < 1e-9 and abs(sum(shares.values()) - 1) < 1e-9
    assert capped_shares({"a": 70, "b": 30}, 0.4) == {"a": 0.5, "b": 0.5}


def test_mix(spark):
    rows = odd_texts(11, n=300)
    docs = documents(spark, rows, ["hot", "hot", "hot", "a", "b", None])
    out = mix(docs, ceiling=0.4, block=4, frame=100, ranges=8).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in out) == Counter((r["doc_id"], r["text"], r["source"]) for r in docs.collect())
    assert len({r["position"] for r in out}) == len(out)
    taken = sorted((r for r in out if r["in_mix"]), key=lambda r: r["position"])
    assert [r["position"] for r in taken] == list(range(len(taken))) and len(taken) > 200
    shares = capped_shares(Counter(r["source"] for r in out), 0.4)
    q = quotas(shares, 100)
    served = Counter()
    for n, r in enumerate(taken, 1):
        served[r["source"]] += 1
        if n % 4 == 0:
            assert all(abs(served[s] / 4 - q[s] * n / 400) < 1 for s in q)
    left = mixed(docs, ceiling=0.4, block=4, frame=100, ranges=8)
    assert left.columns == docs.columns and left.count() == len(taken)


def test_mix_of_given_weights_and_no_rows(spark):
    docs = documents(spark, odd_texts(12), ["a", "b", "c"])
    out = mix(docs, weights={"a": 1, "b": 1, "absent": 5}, block=2, frame=10).collect()
    assert len(out) == docs.count() and {r["source"] for r in out if r["in_mix"]} == {"a", "b"}
    assert all(r["position"] is None and not r["in_mix"] for r in out if r["source"] == "c")
    assert mix(docs.limit(0)).collect() == []


@pytest.mark.parametrize("per_range", [40, 1])
def test_shards(spark, monkeypatch, per_range):
    monkeypatch.setattr(ranges, "SAMPLES_PER_RANGE", per_range)  # a poor sample costs balance of tasks only
    rows = odd_texts(13, n=400) + [(5000 + i, "copy of one text") for i in range(300)] + [(None, None)] * 3
    docs = documents(spark, rows)
    out = shard(docs, shards=6, ranges_per_shard=4, whole_group=0.05).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    by = defaultdict(list)
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 8 and r["law"] == "bytes" and r["grown_shard"] is None
        by[r["shard"]].append(r)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    total, most = sum(r["size"] for r in out), max(r["size"] for r in out)
    assert all(abs(sum(r["size"] for r in v) - total / 6) <= 2 * most + 0.05 * total / 6 for v in by.values())
    assert "lang" in out[0].asDict() and out[0].asDict().keys() >= set(docs.columns)


def test_columns_named_like_the_operator_s_own(spark):
    docs = spark.createDataFrame([(i, f"text {i % 3}", i, str(i), None, -i, "r", 0.5) for i in range(20)],
                                 "doc_id long, text string, __n long, __h string, __id string, __range int, row string, __first double")
    out = shard(docs, shards=2).collect()
    assert sorted((r["doc_id"], r["__n"], r["__h"], r["__id"], r["__range"], r["row"], r["__first"]) for r in out) == [
        (i, i, str(i), None, -i, "r", 0.5) for i in range(20)]


def test_no_rows(spark):
    assert shard(documents(spark, []).limit(0)).collect() == []


def test_range_index(spark):
    import random
    r = random.Random(1)
    for n in (0, 1, 2, 7, 30):
        cuts = sorted({(r.randrange(5), r.randrange(50) - 25) for _ in range(n)})
        keys = [(a, b) for a in range(5) for b in range(-26, 26, 3)]
        df = spark.createDataFrame(keys, "a long, b long")
        got = df.select("a", "b", ranges.range_index([df.a, df.b], cuts).alias("i")).collect()
        assert all(x["i"] == sum(c <= (x["a"], x["b"]) for c in cuts) for x in got)
