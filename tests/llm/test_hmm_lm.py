"""Hidden Markov chains against sums over all state paths; the language model against a plain reading."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import hmm, hmm_lm
from lakemart.llm.queries import op12_hmm_scores


def some_chain(states=3, symbols=5, seed=1):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((symbols, states)) ** 3
    return hmm.Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def all_paths(chain, sequence):
    """Probability of a sequence, and expected counts, from every path of states."""
    k = len(chain.start)
    total, start, move, emit = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros_like(chain.emit)
    for path in itertools.product(range(k), repeat=len(sequence)):
        p = chain.start[path[0]] * math.prod(chain.emit[x, s] for x, s in zip(sequence, path)) * math.prod(chain.move[a, b] for a, b in itertools.pairwise(path))
        total += p
        start[path[0]] += p
        for x, s in zip(sequence, path):
            emit[x, s] += p
        for a, b in itertools.pairwise(path):
            move[a, b] += p
    return total, start / total, move / total, emit / total


@pytest.mark.parametrize(("segment", "block"), [(1024, 400_000), (3, 400_000), (2, 5), (1, 1), (4, 3)])
def test_all_paths(monkeypatch, segment, block):
    """Whatever the cuts into segments and blocks."""
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    monkeypatch.setattr(hmm, "BLOCK", block)
    chain = some_chain()
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 5, n) for n in (1, 7, 2, 3, 6, 1, 4, 5)]
    want = [all_paths(chain, s) for s in sequences]
    flat, sizes = np.concatenate(sequences), np.array([len(s) for s in sequences])
    assert np.allclose(hmm.log_likelihoods(chain, flat, sizes), [math.log(w[0]) for w in want])
    counts = hmm.Counts(chain)
    counts.add(flat, sizes)
    assert math.isclose(counts.likely, sum(math.log(w[0]) for w in want))
    for got, k in ((counts.start, 1), (counts.move, 2), (counts.emit, 3)):
        assert np.allclose(got, sum(w[k] for w in want))


@pytest.mark.parametrize("block", [400_000, 4])
def test_one_state_to_a_sequence(monkeypatch, block):
    monkeypatch.setattr(hmm, "BLOCK", block)
    chain = some_chain()
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 5, n) for n in (3, 1, 9, 2)]
    start, emit = np.zeros(3), np.zeros((5, 3))
    for own in sequences:
        p = chain.start * chain.emit[own].prod(0)
        p /= p.sum()
        start += p
        for x in own:
            emit[x] += p
    got = hmm.mixture_counts(chain, np.concatenate(sequences), np.array([len(s) for s in sequences]))
    assert np.allclose(got[0], start) and np.allclose(got[1], emit)


def test_long_sequences_do_not_vanish():
    chain = some_chain(4, 50)
    flat = np.random.default_rng(3).integers(0, 50, 60_000)
    whole = hmm.log_likelihoods(chain, flat, np.array([60_000]))[0]
    a = chain.start
    want = 0.0
    for x in flat:  # one symbol after another
        a = a * chain.emit[x]
        want += math.log(a.sum())
        a = a / a.sum() @ chain.move
    assert math.isclose(whole, want, rel_tol=1e-12)


def plain_base(rows):
    """The contract's columns but the score."""
    held = {i: crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {
        i: (held[i], len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }, c


def test_query(spark, sf_small, monkeypatch):
    monkeypatch.setattr(hmm_lm, "SYMBOLS", 2000)  # so that there are frequent words beside them, and rare ones
    monkeypatch.setattr(hmm_lm, "FREQUENT", 4000)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = plain_base(rows)
    got = {r.doc_id: r for r in op12_hmm_scores(spark, sf_small).collect()}
    assert got.keys() == want.keys()
    for i, (held, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)  # better than single words


def test_score_is_the_model_probability(spark, sf_small, monkeypatch):
    """The score read from the chain and the counts alone, word by word; and rounds that learn."""
    monkeypatch.setattr(hmm_lm, "SYMBOLS", 500)
    monkeypatch.setattr(hmm_lm, "FREQUENT", 1500)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    own = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    known = hmm_lm.vocabulary(own.filter("not held_out"))
    _, c = plain_base(rows)
    assert {bytes(r.word): r.c for r in known.table.collect()} == dict(c)
    encoded = hmm_lm.encode(own, known, F.col("held_out"))
    chain, history = hmm_lm.train(encoded, known)
    assert history == sorted(history) and len(history) == hmm_lm.ROUNDS
    assert np.allclose(chain.emit.sum(0), 1) and np.allclose(chain.move.sum(1), 1)
    number = {w: i for i, w in enumerate(known.frequent[: known.symbols])}
    assert 0 < len(number) <= 500 < len(known.frequent) <= 1500
    assert {w for w, n in c.items() if n >= known.least} == set(known.frequent)
    assert min(c[w] for w in number) > max(n for w, n in c.items() if w not in number)
    mass, many = Counter(), Counter()
    for w, n in c.items():
        if w not in number:
            mass[hmm_lm.class_of(w)] += n
            many[hmm_lm.class_of(w)] += 1
    got = {r.doc_id: r.score for r in hmm_lm.score(encoded, known, chain).collect()}
    for i, text in rows[:60]:
        a, want = chain.start, 0.0
        for w in [*(text or "").encode().lower().split(), b""]:
            k = hmm_lm.class_of(w)
            row = number.get(w, len(number) + k)
            within = 1.0
            if w not in number and mass[k]:
                within = (c[w] - 0.75 if w in c else 0.75 * many[k]) / mass[k]
            a = a * chain.emit[row]
            want += math.log10(a.sum() * within)
            a = a / a.sum() @ chain.move
        assert math.isclose(got[i], want, rel_tol=1e-9)


def test_classes_in_spark_and_python(spark):
    words = [b"", b"a", b"ab", b"abc", "äé".encode(), b"x" * 50, "€€".encode()]
    made = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    got = made.select((F.crc32(F.substring("word", -3, 3)) % hmm_lm.CLASSES).alias("k")).collect()
    assert [r.k for r in got] == [hmm_lm.class_of(w) for w in words]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "A b a"), (5, "b " * 40_000), (8, "new  x"), (8, "new  x")]
    docs = spark.createDataFrame([(i, t, 1, "x", [0]) for i, t in rows], "doc_id long, text string, key int, id string, symbols array<int>")
    out = hmm_lm.model_scores(docs, F.col("doc_id") == 8).collect()
    assert len(out) == len(rows) and {r.train_tokens for r in out} == {1 + 1 + 1 + 4 + 40_001}
    assert sorted((r.n_tokens, r.n_known) for r in out) == [(1, 1)] * 3 + [(3, 1), (3, 1), (4, 4), (40_001, 40_001)]
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert hmm_lm.model_scores(docs.limit(0), F.lit(False)).count() == 0
    alone = hmm_lm.model_scores(docs, F.lit(True)).collect()  # nothing to learn from
    assert {(r.train_tokens, r.n_known) for r in alone} == {(0, 0)} and all(math.isfinite(r.score) for r in alone)


def test_symbols_are_one_value_for_each_text():
    """Read back from slices and joined batches as well; the largest number of a symbol or class fits."""
    texts = [[5], [1, hmm_lm.SYMBOLS + hmm_lm.CLASSES - 1, 0], [7, 7]]
    column = hmm_lm._texts_symbols(np.concatenate(texts).astype(hmm_lm.SYMBOL), np.cumsum([len(t) for t in texts]))
    for own, want in ((column, texts), (column.slice(1), texts[1:]), (column.slice(1, 1), texts[1:2])):
        flat, sizes = hmm_lm._sequences(own)
        assert flat.tolist() == [x for t in want for x in t] and sizes.tolist() == [len(t) for t in want]
