"""Anchor expansion against plain regular expressions."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return out


def base(text):
    return [s for s in pii.spans_in(text, pii._automaton()) if s[0] in pii.BASE]


PIECES = st.sampled_from(["@", "a", "b.c", ".", "-", " ", "+", "1", "25", "255", "300", "1.2.3.4", "4111 1111 1111 1111", "+1 (017) 555-7713", "x@y.z", "é", "_", "%", "token", "://", "5927243074273351", "(", ")", "00001"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert base(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789. -+@a()", max_size=80))
def test_base_spans_equal_plain_patterns_on_dense_text(text):
    assert base(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("see https://ex.org/a?b=1, then", "url", "https://ex.org/a?b=1"),
        ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x', "secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
        ("IBAN: GB82 WEST 1234 5698 7654 32 x", "account", "GB82 WEST 1234 5698 7654 32"),
    ],
)
def test_added_kinds(text, kind, value):
    assert [text[a:b] for k, a, b in pii.spans_in(text, pii._automaton()) if k == kind] == [value]


@pytest.mark.parametrize("text", ["a token of thanks", "tokens = many things", "IBAN: GB00 WEST 1234 5698 7654 32", "://x", "mytoken = abcdefgh1"])
def test_clean_text_is_left_alone(text):
    assert not [s for s in pii.spans_in(text, pii._automaton()) if s[0] not in pii.BASE]


def test_mask_joins_overlaps():
    assert pii.masked("abcdefgh", [("card", 2, 6), ("ip", 3, 4), ("url", 7, 8)]) == "ab<CARD>g<URL>"


def test_long_runs_take_linear_time():
    for unit in ("1", "1.", "a", "@", "+1", "1 "):
        pii.spans_in(unit * 300_000, pii._automaton())


def test_frames(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "mail a.b@c.de now", None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((str(r.doc_id), len(r.spans)) for r in pii.find_pii(docs).collect())
    assert got == [("1", 0), ("2", 0), ("2", 0), ("None", 1)]
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    assert {r.text for r in masked.collect()} == {None, "", "mail <EMAIL> now"}
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_query_equals_plain_patterns(spark, sf_small):
    import hashlib

    from lakemart.llm.queries import op10_pii

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op10_pii(spark, sf_small).collect()}
    assert got.keys() == docs.keys()
    for k, text in docs.items():
        want = plain(text or "")
        assert got[k].base_sha256 == hashlib.sha256(",".join(f"{a}:{b}:{c}" for a, b, c in want).encode()).hexdigest()
        assert (got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone) == tuple(sum(s[0] == x for s in want) for x in pii.BASE)
