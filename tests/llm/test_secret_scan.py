import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulselake.llm import secret_scan
from pulselake.llm.automaton import compiled
from pulselake.llm.queries import op13_secret_scan
from tests.llm.frames import documents

RULES = secret_scan.BASE + secret_scan.MORE
BITS = ["token", "ToKen", "password", "passwd", "secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "abcdefgh",
        "0123456789abcdef", "AKIA", "ABCDEF012345", "é", "中", "\n", "ghp_", "a" * 36, "eyJab", ".", "-----BEGIN ", "RSA ",
        "PRIVATE KEY-----", "xoxb-", "x", "==", "f" * 40, "ſ", "-"]


def plain(text):
    out = []
    for k, rule in enumerate(RULES):
        head = f"(?ai:{rule.head})" if rule.fold else rule.head
        body, least = ("[0-9a-f]+", 32) if rule.kind == "hex" else (rule.body, rule.least)
        out += [(m.start(), k, m.end()) for m in re.finditer(f"({head})(?P<v>{body})", text) if len(m["v"]) >= least]
    return sorted(out)


def found(texts):
    encoded = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0] + [len(e) for e in encoded])
    spans = secret_scan.find(data, offsets, RULES)
    return [secret_scan._in_characters(np.frombuffer(e, np.uint8), s) for e, s in zip(encoded, spans)]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=40).map("".join), min_size=1, max_size=12))
def test_spans_are_those_of_a_backtracking_matcher(texts):
    assert found(texts) == [plain(t) for t in texts]


def test_a_short_value_still_takes_its_place():
    # The dropped match of "token" covers "secret", so what follows is no match of its own.
    assert found(["token=secret:abcdefgh"]) == [[]]
    assert found(["token=x secret:abcdefgh"]) == [[(8, 0, 23)]]


@pytest.mark.parametrize("regex", ["(a|ab)(c|bcd)*d?", "[^a]b{2,3}", "x(a*b)+", "(ab|a){0,2}c", "a{3}|b+"])
def test_automata_accept_what_the_expression_matches(regex):
    automaton, r = compiled([(regex, False)]), random.Random(regex)
    for _ in range(300):
        text = "".join(r.choice("abcdx") for _ in range(r.randrange(9)))
        ends = [e for e in range(len(text) + 1) if re.fullmatch(regex, text[:e])]
        assert automaton.ends(text.encode(), 0) == max(ends, default=-1)


def test_the_automaton_is_minimal():
    one, two = compiled([("(ab|ac)*", False)]), compiled([("(a(b|c))*", False)])
    assert len(one.step) // one.width == len(two.step) // two.width == 3


def test_lanes_agree_with_one_pass():
    r = random.Random(3)
    text = np.frombuffer("".join(r.choice(BITS) for _ in range(30_000)).encode() + b"f" * 90_000, np.uint8)
    automaton = compiled([(x.regex, False) for x in RULES], backwards=True, anywhere=True)
    state, want = 0, []
    for b in text.tolist():
        state = automaton.step[state + automaton.classes[b]]
        want.append(state)
    assert automaton.states(text).tolist() == want
    assert len(automaton.states(text[:0])) == 0


ODD = [(1, "password = 'hunter2hunter2' x"), (2, None), (3, ""), (None, "é AKIA0123456789AB"), (4, "é" * 50 + "a" * 40),
       (5, "token=short"), (4, "é" * 50 + "a" * 40), (6, "中 " * 200_000 + "api_key: 0123456789abcdef0123456789abcdef")]


def test_odd_rows(spark):
    rows = secret_scan.scan(documents(spark, ODD)).collect()
    want = sorted(((i, [(RULES[k].kind, a, b) for a, k, b in plain(t or "")]) for i, t in ODD), key=str)
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in rows), key=str) == want
    assert secret_scan.report(documents(spark, ODD).limit(0)).count() == 0
    by_id = {r.doc_id: r for r in secret_scan.report(documents(spark, ODD)).collect()}
    assert (by_id[6].n_assign, by_id[6].n_hex, by_id[6].spans) == (1, 1, "assign:400000:400041,hex:400009:400041")
    assert by_id[None].spans == "access:2:18" and by_id[5].spans == ""


def test_redaction_keeps_all_else(spark):
    docs = documents(spark, ODD)
    out = secret_scan.redact(docs)
    assert out.schema == docs.schema
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] == "[assign]' x" and texts[2] is None and texts[None] == "é [access]" and texts[5] == "token=short"
    assert texts[6] == "中 " * 200_000 + "[assign]"


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op13_secret_scan(spark, sf).collect():
        assert r.spans == ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in plain(texts[r.doc_id]))
