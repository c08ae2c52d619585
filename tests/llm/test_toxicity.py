import random
from collections import Counter

import numpy as np

from pulselake.llm.toxicity import DISCOUNT, LONGEST, ORDERS, Model, score
from pulselake.llm.vectorized import LETTER, words


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def plain_ratio(word, vocabulary, counts, trigrams):
    """The same model by dictionaries."""
    w = b" " + word[:LONGEST] + b" "
    three, two, kinds = Counter(trigrams), Counter(), Counter()
    for g, n in trigrams.items():
        two[g >> 8] += n
        kinds[g >> 8] += 1
    total = [0.0, 0.0]
    tables = []
    for c in (0, 1):
        by = {}
        for order in ORDERS:
            n = Counter()
            seen = set()
            for v, k in zip(vocabulary, counts):
                if not k[c]:
                    continue
                p = b" " + v + b" "
                for i in range(len(p) - order + 1):
                    if order == max(ORDERS):
                        n[p[i:i + order]] += k[c]
                    else:
                        key = p[i - 1:i + order] if i else p[:order]
                        if (i > 0, key) not in seen:
                            seen.add((i > 0, key))
                            n[p[i:i + order]] += 1
            by[order] = n
        tables.append(by)
    for i in range(1, len(w)):
        g = (w[i - 2] << 16) | (w[i - 1] << 8) | w[i]
        base = 1 / 256 if i == 1 else (max(three[g] - DISCOUNT, 0) + (DISCOUNT * kinds[g >> 8] + 1e-3) / 256) / (two[g >> 8] + 1e-3)
        for c in (0, 1):
            p = base
            for order in ORDERS:
                if i < order - 1:
                    break
                n = tables[c][order]
                context = w[i - order + 1:i]
                follow = [x for x in n if x[:-1] == context]
                all_n = sum(n[x] for x in follow)
                if all_n:
                    p = (max(n[w[i - order + 1:i + 1]] - DISCOUNT, 0) + DISCOUNT * len(follow) * p) / all_n
            total[c] += np.log(p)
    return total[1] - total[0]


def test_ratios_equal_a_plain_model():
    r = random.Random(3)
    vocabulary = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 9))).encode() for _ in range(60)})
    counts = np.array([[r.randint(0, 3), r.randint(0, 3)] for _ in vocabulary])
    trigrams = Counter()
    for v in vocabulary:
        p = b" " + v + b" "
        for i in range(len(p) - 2):
            trigrams[(p[i] << 16) | (p[i + 1] << 8) | p[i + 2]] += 2
    model = Model(vocabulary, counts, np.array(list(trigrams)), np.array(list(trigrams.values()), float))
    asked = [*vocabulary[:20], b"abcabcx", b"zzz", b"a", b"\xc3\xa9ab"]
    data, offsets = packed([" ".join(a.decode() for a in asked)])
    starts, ends, _ = words(data, offsets, LETTER)
    got = model.word_ratios(data, starts, ends)
    want = [plain_ratio(a, vocabulary, counts, trigrams) for a in asked]
    assert np.allclose(got, want, rtol=1e-3, atol=1e-4)


def table(spark, n=800):
    r = random.Random(5)
    plain = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [r.choice(plain) for _ in range(r.randint(5, 80))]
        if toxic:
            for _ in range(1 + len(text) // 15):
                text[r.randrange(len(text))] = r.choice(["xyzzy", "xyzzier", "kwyx"]) + r.choice(["", "ab", "cd"])
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), labels


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    more = spark.createDataFrame([(9001, None, None), (9002, "", "x"), (None, "abc", "y"), (9003, "abc " * 30000, "z"),
                                  (9003, "abc " * 30000, "z")], "doc_id long, text string, score string")
    out = score(docs.union(more), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")).collect()
    assert len(out) == 805 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    truth = dict(labels)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert {r["predicted"] for r in out if r["doc_id"] in (9001, 9002)} == {0}
    assert len({r["score"] for r in out if r["doc_id"] == 9003}) == 1


def test_labels_of_one_class_or_none(spark):
    docs, labels = table(spark, 30)
    one = [x for x in labels if not x[1]]
    for some in (one, []):
        out = score(docs, spark.createDataFrame(some, "doc_id long, toxic int")).collect()
        assert len(out) == 30 and {r["score"] for r in out} == {0.0}
    assert score(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() == []
