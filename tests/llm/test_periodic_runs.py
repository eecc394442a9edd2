"""Periodic runs against a plain search of every period, and the edge rows."""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import periodic_runs as pr
from lakemart.llm.queries import op11_periodic_runs


def plain_runs(words):
    """(start, length, period) by looking at every period's stretches of equal words."""
    n = len(words)
    w = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if n else np.zeros(0, int)
    out = {}
    for p in range(1, n // 4 + 1):
        same = np.concatenate([[False], w[:-p] == w[p:], [False]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(same))
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a + p >= max(6, 4 * p):
                out.setdefault((a, b - a + p), p)
    return sorted((s, n, p) for (s, n), p in out.items())


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n and (h := crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs([w.hex() for w in words])
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=6))
def test_small_alphabets(texts):
    got = pr.find_runs([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=9), st.integers(1, 12)), min_size=1, max_size=12), st.integers(0, 40))
def test_repeated_stretches(parts, block):
    """Runs of many periods end to end, in blocks of a few grid places."""
    text = [w for stretch, times in parts for w in stretch * times]
    kept, pr.BLOCK = pr.BLOCK, 1 + block
    try:
        got = pr.find_runs([np.array(text, np.int64), np.array(text[::-1], np.int64)])
    finally:
        pr.BLOCK = kept
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(text), plain_runs(text[::-1])]


@pytest.mark.parametrize("text", [[0] * 5000, [0, 1] * 2500, list(range(700)) * 6, [0] * 30 + [1] + [0] * 30, list(range(5000))])
def test_long_texts(text):
    (got,) = pr.find_runs([np.array(text, np.int64)])
    assert [tuple(r) for r in got.tolist()] == plain_runs(text)


@given(st.lists(st.integers(0, 3), min_size=2, max_size=50), st.data())
def test_extensions(words, data):
    words = np.array([*words, 9], np.int64)
    ext = pr.Extensions(words)
    a, b = sorted(data.draw(st.lists(st.integers(0, len(words) - 1), min_size=2, max_size=2, unique=True)))
    n = 0
    while b + n < len(words) and words[a + n] == words[b + n]:
        n += 1
    assert ext.of(np.array([a]), np.array([b])).tolist() == [n]


def test_query_equals_plain_search(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in op11_periodic_runs(spark, sf_small).collect()}
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs}
    assert got == want
    assert sum(r[0] > 0 for r in want.values()) > len(want) // 20


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 9), (4, "a b " * 7), (4, "a b " * 7), (5, "x y z w v u"), (6, "ä é ä é ä é ä é " * 20_000), (17, "one two")]
    docs = spark.createDataFrame([(i, t, "c", [1]) for i, t in rows], "doc_id long, text string, kept string, runs array<int>")
    got = pr.digests(pr.periodic_runs(docs, change=pr.planted)).collect()
    assert sorted((tuple(r) for r in got if r[0] != 6), key=str) == sorted(((i, *plain_row(i, t)) for i, t in rows if i != 6), key=str)
    assert [(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in got if r[0] == 6] == [(1, 0, 160_000, 2, 80_000_000)]
    out = {r.doc_id: (r.n_words, r.kept) for r in pr.periodic_runs(docs.filter("doc_id = 6")).collect()}
    assert out == {6: (160_000, "ä é")}
    assert pr.periodic_runs(docs.limit(0)).count() == 0
