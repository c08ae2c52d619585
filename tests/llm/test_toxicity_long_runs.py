"""Every byte of a run without blanks is scored."""

import random
from collections import Counter

import numpy as np
import pytest

from pulselake.llm import toxicity
from pulselake.llm.toxicity import LONGEST, Model, score
from pulselake.llm.vectorized import LETTER, words
from tests.llm import test_toxicity
from tests.llm.test_toxicity import packed, plain_ratio


def test_long_words_equal_a_plain_model(monkeypatch):
    monkeypatch.setattr(test_toxicity, "LONGEST", 10 ** 9)  # the plain model sees whole words
    r = random.Random(6)
    lengths = [1, 3, 7, LONGEST - 1, LONGEST, LONGEST + 1, LONGEST + 2, LONGEST + 6, 2 * LONGEST, 2 * LONGEST + 1, 150]
    vocabulary = sorted({"".join(r.choice("abc") for _ in range(n)).encode() for n in lengths * 2})
    counts = np.array([[r.randint(0, 3), r.randint(0, 3)] for _ in vocabulary])
    trigrams = Counter()
    for v in vocabulary:
        p = b" " + v + b" "
        for i in range(len(p) - 2):
            trigrams[(p[i] << 16) | (p[i + 1] << 8) | p[i + 2]] += 2
    model = Model(vocabulary, counts, np.array(list(trigrams)), np.array(list(trigrams.values()), float))
    asked = [*vocabulary, *["".join(r.choice("abcd") for _ in range(n)).encode() for n in lengths]]
    data, offsets = packed([" ".join(a.decode() for a in asked)])
    starts, ends, _ = words(data, offsets, LETTER)
    got = model.word_ratios(data, starts, ends)
    want = [plain_ratio(a, vocabulary, counts, trigrams) for a in asked]
    assert np.allclose(got, want, rtol=1e-3, atol=1e-3)


@pytest.mark.parametrize("blank", ["", "，"])
def test_toxic_expression_behind_the_first_bytes_of_a_run(spark, blank):
    r = random.Random(9)
    plain = ["".join(chr(0x4E00 + r.randrange(150)) for _ in range(2)) for _ in range(200)]
    bad = ["".join(chr(0x6000 + r.randrange(40)) for _ in range(4)) for _ in range(3)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        text = [r.choice(plain) for _ in range(r.randint(30, 60))]
        if toxic:
            for _ in range(3):  # never within the first 40 bytes
                text.insert(r.randint(10, len(text)), r.choice(bad))
        rows.append((i, blank.join(text)))
        labels.append((i, int(toxic)))
    assert all(not any(b in t.encode()[:toxicity.LONGEST].decode("utf-8", "ignore") for b in bad) for _, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = score(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r["predicted"] == labels[r["doc_id"]][1] for r in out if r["held_out"]]
    assert len(held) > 100 and np.mean(held) > 0.95
