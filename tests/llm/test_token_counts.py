import random

import public_tokenizers as P
import pytest

from pulselake.llm.token_counts import Vocabulary, count, count_tokens

PATHS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def voc():
    return Vocabulary(*PATHS)


def whole(voc, text):
    return voc.full.encode(text, add_special_tokens=False).ids


def test_both_libraries_agree_below_0250(voc):
    for cp in range(0x250):
        c = chr(cp)
        for text in (c, f"a{c}b", f" {c} {c}{c}", f"1{c}2 {c}x", f"{c}\n{c} ", f"'{c}s .{c}", f"a {c}  b"):
            assert voc.fast.encode_ordinary(text) == whole(voc, text), (cp, text)


@pytest.mark.parametrize("seed", range(30))
def test_spliced_chunks_equal_the_whole(voc, seed):
    r = random.Random(seed)
    parts = [" the", " wörld", "\n\n", "   ", "abc", "123", " 中文", "🙂", "<|endoftext|>", "'s", "\t", "….", "x" * 40]
    text = "".join(r.choice(parts) for _ in range(r.randint(0, 400)))
    for chunk, overlap in ((64, 8), (50, 2), (200, 16)):
        assert count(text, voc.ends, chunk, overlap) == len(whole(voc, text))


def test_no_boundary_at_all(voc):
    text = "aé" * 500
    assert count(text, voc.ends, 64, 8) == len(whole(voc, text))


SCRIPTS = {
    "latin": "The quick brown fox, it's said, jumps over 13 lazy dogs. ",
    "cyrillic": "Съешь же ещё этих мягких французских булок, да выпей чаю. ",
    "greek": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία του κόσμου· ",
    "chinese": "天地玄黄，宇宙洪荒。日月盈昃，辰宿列张，寒来暑往，秋收冬藏。",
    "arabic": "نص حكيم له سر قاطع وذو شأن عظيم، مكتوب على ثوب أخضر. ",
    "hindi": "ऋषियों को सताने वाले दुष्ट राक्षसों के राजा रावण का सर्वनाश। ",
    "emoji with blanks": "🙂🙃 🚀🌍🌎 👩‍🚀\n",
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_long_texts_of_every_script_are_encoded_little_more_than_once(voc, script):
    text = SCRIPTS[script] * (200_000 // len(SCRIPTS[script]))
    seen = []

    def ends(part):
        seen.append(len(part))
        return voc.ends(part)

    assert count(text, ends, 1 << 13, 256) == len(whole(voc, text))
    assert sum(seen) <= 1.2 * len(text) and max(seen) <= 3 << 13


def test_text_without_a_place_to_cut_is_encoded_once(voc):
    text, seen = "🙂" * 30_000, []
    assert count(text, lambda t: seen.append(len(t)) or voc.ends(t), 1 << 12, 256) == len(whole(voc, text))
    assert sum(seen) == len(text)


def test_special_strings_at_every_cut(voc):
    text = "<|endoftext|>" * 300
    assert count(text, voc.ends, 64, 8) == 300


def test_frame(spark, voc):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (None, "", "y"), (3, "<|endoftext|> hi", None),
            (4, "word " * 40000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, count_tokens(docs, *PATHS).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(whole(voc, t or ""))) for i, t, _ in rows), key=str)
    assert count_tokens(docs.limit(0), *PATHS).collect() == []
