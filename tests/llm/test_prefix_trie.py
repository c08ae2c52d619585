import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from pulselake.llm.prefix_trie import Limits, prefix_trie, rebuilt_trie
from pulselake.llm.queries import op11_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, heads=True):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [p for _, p in sorted(v, key=lambda x: x[0])] for c, v in by.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(int)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        conv = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(conv) + 1):
            members[tuple(conv[:d])].append(c)
        ends[tuple(conv)].append(c)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        s = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += s
            leaves[k[:d]] += not children[k]
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest())
                   for k, m in members.items()), key=str)


def frame(spark, rows):
    """Conversations with further columns of the operator's own names."""
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows],
                                 "conv_id long, turn long, role string, text string, key string, depth int, turns string")


def conversations(seed, number=150, spread=1):
    r, out = random.Random(seed), []
    for c in range(number):
        for t in range(r.randrange(1, 6)):
            out.append((c * spread, None if t == 0 and r.random() < 0.1 else t, r.choice(["user", None]) if t % 2 else "user",
                        r.choice(["hi there", "x  y\tz", "", None, "ünï\ncode"])))
    return out


SMALL = Limits(block=7, waiting=3, ends=2)


@pytest.mark.parametrize("limits", [Limits(), SMALL])
@pytest.mark.parametrize("spread", [1, 3, 20])
def test_trie_of_rebuilt_conversations(spark, limits, spread):
    rows = conversations(spread, spread=spread) + [(None, 1, "user", "nobody's")]
    got = rebuilt_trie(frame(spark, rows), limits)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("limits", [Limits(), SMALL])
def test_copies_over_many_shards_and_a_very_long_one(spark, limits):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]  # one path, many shards
    rows += [(1000 + c, 0, "user", "turn 0") for c in range(50)] + [(2000, t, "user", f"turn {t}") for t in range(300)]
    got = prefix_trie(frame(spark, rows), limits)
    want = plain(rows, heads=False)
    assert len(want) == 301 and sorted(map(tuple, got.collect()), key=str) == want


def test_repeated_rows_count_each(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    assert sorted(map(tuple, prefix_trie(frame(spark, rows)).collect()), key=str) == plain(rows, heads=False)


def test_no_rows(spark):
    assert rebuilt_trie(frame(spark, [(1, 1, "u", "t")]).limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op11_prefix_trie(spark, sf).collect()), key=str) == plain(rows)
