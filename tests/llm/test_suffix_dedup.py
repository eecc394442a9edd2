"""Merging of front-coded runs, and removal against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import suffix_dedup as sd


def brute(texts, length):
    """Per text: maximal covered ranges."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mask = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                mask[i : i + length] = True
        out.append([(a, b + 1) for a, b in sd._ranges(mask)])
    return out


STRINGS = st.lists(st.binary(min_size=1, max_size=12) | st.text("ab", min_size=1, max_size=30).map(str.encode), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(STRINGS, min_size=1, max_size=9))
def test_merge_is_a_sort_with_true_prefixes(groups):
    blobs = [sd.front_coded([(s, 1, False, (i, 0, 0)) for s in sorted(g)]) for i, g in enumerate(groups)]
    merged = list(sd.merge_runs(blobs))
    strings = [m[1] for m in merged]
    assert [s for m in merged for s in [m[1]] * m[2]] == sorted(s for g in groups for s in g)
    for (k, s, *_), before in zip(merged[1:], strings):
        want = next((i for i, (x, y) in enumerate(zip(s, before)) if x != y), min(len(s), len(before)))
        assert k == want


def test_equal_windows_have_equal_anchors():
    rng = random.Random(0)
    shared = bytes(rng.choice(b"abcd") for _ in range(300))
    owner = {}
    for before in (b"", b"x" * 37, b"abcabc" * 20):
        data = before + shared + before
        anchors, first, last = sd.segments(data, 40)
        assert first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == len(data) - 40
        for a, i, j in zip(anchors.tolist(), first, last):
            for p in range(i, j + 1):
                assert owner.setdefault(data[p : p + 40], a) == a


def test_long_text_in_blocks():
    data = np.random.default_rng(0).integers(97, 100, 2 * sd._BLOCK + 77, np.uint8).tobytes()
    _, first, last = sd.segments(data, 200)
    assert first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == len(data) - 200


def made_up(seed, n=40):
    rng = random.Random(seed)
    junk = lambda k: "".join(rng.choice("abcdé") for _ in range(k))
    passages = [junk(rng.choice([15, 25, 40, 90])) for _ in range(4)] + ["ab" * 30, "z" * 50]
    texts = [None, "", "a", passages[0]]
    for _ in range(n):
        parts = [junk(rng.randrange(60)) for _ in range(3)]
        texts.append(parts[0] + rng.choice(passages) + parts[1] + rng.choice([*passages, ""]) + parts[2])
    return texts + texts[5:8] + [texts[5]]


@pytest.mark.parametrize(("length", "hot"), [(20, 4000), (20, 3), (9, 4)])
def test_removal_equals_brute_force(spark, length, hot):
    texts = made_up(length + hot)
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4)
    got = {r.doc_id: r for r in sd.remove_repeats(docs, length=length, hot=hot).collect()}
    for (i, t, _), want in zip(rows, brute(texts, length)):
        assert [(s.start, s.end) for s in got[i].spans] == want
        assert got[i].n_bytes == len((t or "").encode()) and got[i].n_removed == sum(b - a for a, b in want)
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_small):
    from lakemart.llm.queries import op7_suffix_dedup

    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op7_suffix_dedup(spark, sf_small).collect()}
    for (i, text), spans in zip(docs, brute([t for _, t in docs], 200)):
        data, kept, at = text.encode(), b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(data), len(data) - len(kept), len(spans))
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert len(got) == len(docs)
