"""Rows with all that may be odd about a table of documents."""

import random
import re

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, size string, shard string, block string, "
        "row string, component string, words string, bucket string, n string, label string")

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark, texts, sources=("s",)):
    """Documents of (id, text) with further columns, some null, that clash with the operators' own names."""
    rows = [(i, t, None, sources[k % len(sources)], None if k % 3 else k, *["x" if k % 2 else None] * 9)
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts(seed, n=40, words=40, vocabulary=12):
    """Copies, near copies, shared passages, empty and long texts, null ids and repeated rows."""
    r = random.Random(seed)
    some = ["The", "of", "and", "tió", "ß", "A1", "zz", "中", "x.y", "go", "No", "10"][:vocabulary]
    passage = " ".join(r.choice(some) for _ in range(30))
    out = []
    for i in range(n):
        kind = r.randrange(8)
        text = " ".join(r.choice(some) + r.choice(["", "", ",", "\n"]) for _ in range(r.randint(0, words)))
        if kind == 0 and out:
            text = r.choice(out)[1]
        elif kind == 1 and out:
            old = (r.choice(out)[1] or "").split(" ")
            old[r.randrange(len(old))] = "new"
            text = " ".join(old)
        elif kind in (2, 3):
            cut = r.randrange(len(passage) - 40)
            text = text[:20] + " " + passage[cut:cut + r.randint(20, 120)] + " " + text[20:]
        out.append((i + 1, text))
    out += [(900, None), (901, ""), (902, " \t\n "), (903, passage * 60), (904, passage), (904, passage), (None, passage + " end"),
            (905, "a"), (906, "a"), (907, "ab " * 50)]
    r.shuffle(out)
    return out
