"""The field against brute force over all taggings, and learning from document labels."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import toxicity as tx
from lakemart.llm.crf import MOST_TOKENS, Chain, Features, sequences, token_features, train


def brute_marginals(chain, scores):
    """P(state 1) of each token by summing over all taggings, and the pair probabilities."""
    n = len(scores)
    total, on, pairs = 0.0, np.zeros(n), np.zeros((n - 1, 2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        w = chain.first[tags[0]] * np.exp(sum(s for s, t in zip(scores, tags) if t))
        for a, b in zip(tags, tags[1:]):
            w *= chain.factors[a, b]
        total += w
        on += w * np.array(tags)
        for i, (a, b) in enumerate(zip(tags, tags[1:])):
            pairs[i, a, b] += w
    return on / total, pairs / total


def test_marginals_equal_brute_force():
    rng = np.random.default_rng(1)
    chain = Chain(np.exp(rng.normal(size=(2, 2))), np.exp(rng.normal(size=2)))
    sizes = np.array([3, 1, 7, 2])
    starts = np.cumsum(sizes) - sizes
    scores = rng.normal(size=sizes.sum()) * 2
    p, moves = chain.expectations(scores, starts, sizes)
    assert np.allclose(p, chain.marginals(scores, starts, sizes))
    for a, n in zip(starts, sizes):
        want, pairs = brute_marginals(chain, scores[a : a + n])
        assert np.allclose(p[a : a + n], want)
        moves = moves - pairs.sum(axis=0)
    assert np.allclose(moves, 0)


def test_sequences():
    ends = np.array([0, 1, 0, 0, 1, 0], bool)
    starts, sizes = sequences(ends, np.array([0, 3]))
    assert starts.tolist() == [0, 2, 3, 5] and sizes.tolist() == [2, 1, 2, 1]
    starts, sizes = sequences(np.zeros(2 * MOST_TOKENS + 5, bool), np.array([0]))
    assert sizes.tolist() == [MOST_TOKENS, MOST_TOKENS, 5]
    assert sequences(np.zeros(0, bool), np.zeros(0, int))[0].size == 0


def test_training_finds_token_and_transition():
    rng = random.Random(0)
    words = ["good", "bad", "day", "sun"]
    text = [rng.choice(words) for _ in range(3000)]
    ids = np.array([words.index(w) for w in text])
    weights, bias, chain = train(Features(words), ids, (ids == 1).astype(int), np.array([0]), np.array([3000]), rounds=100)
    assert weights["w=bad"] > 1 and bias < 0


def corpus(n, seed):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(300)]
    nasty = ["blarg", "zounds", "fiegdich", "fiegauch", "fiegheit"]
    texts, toxic = [], []
    for _ in range(n):
        tokens = [rng.choice(common) for _ in range(rng.randrange(20, 120))]
        y = rng.random() < 0.15
        if y:
            for _ in range(rng.randrange(1, 5)):
                tokens.insert(rng.randrange(len(tokens)), rng.choice(nasty))
        texts.append(" ".join(tokens).capitalize() + ".")
        toxic.append(y != (rng.random() < 0.01))  # some labels are wrong
    return texts, np.array(toxic)


def test_held_out_accuracy():
    model = tx.fit(*corpus(1500, 0))
    texts, toxic = corpus(600, 1)
    tagged = tx.Tagger(model).tag([*texts, "", " \n"])[1]
    scores = model.score(*tx.summaries(tagged))
    assert ((scores[:-2] >= 0.3) == toxic).mean() > 0.97
    assert scores[-1] == scores[-2] < 0.1
    assert ((scores >= 0) & (scores <= 1)).all()


def test_weights_count_like_repeated_sequences():
    rng = np.random.default_rng(4)
    words = ["good", "bad", "day"]
    parts = [rng.integers(0, 3, n) for n in (5, 3, 8)]
    often = [1, 4, 2]
    twice = [p for p, k in zip(parts, often) for _ in range(k)]

    def learnt(parts, weights):
        ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        return train(Features(words), ids, (ids == 1).astype(int), np.cumsum(sizes) - sizes, sizes, weights=weights)

    one, two = learnt(parts, np.array(often, float)), learnt(twice, None)
    assert one[0].keys() == two[0].keys() and all(np.isclose(one[0][k], two[0][k]) for k in one[0])
    assert np.allclose(one[2].factors, two[2].factors) and np.allclose(one[2].first, two[2].first)


def test_long_texts_and_every_label_teach(spark):
    # the offending word stands only in texts of more than 10,000 characters, and near their ends
    rng = random.Random(3)
    common = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(240):
        n = 4000 if i % 6 == 0 else 60
        tokens = [rng.choice(common) for _ in range(n)]
        if i % 12 == 0:
            tokens[-5] = "blarg"
        rows.append((i, " ".join(tokens) + ".", int(i % 12 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3).cache()
    model = tx.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scores = {r.doc_id: r.score for r in tx.score_texts(table, model).collect()}
    assert all((scores[i] >= 0.3) == bool(y) for i, _, y in rows)


def test_counts_over_the_table_equal_plain_counts(spark):
    texts, toxic = corpus(400, 2)
    rows = [(str(i), t, bool(y)) for i, (t, y) in enumerate(zip(texts, toxic))]
    table = spark.createDataFrame(rows, "key string, said string, toxic boolean").repartition(3)
    plain = tx.MarkCounts()
    for t, y in zip(texts, toxic):
        plain.add(t, y)
    assert {r.mark: (r.n, r.bad) for r in tx.mark_counts(table).collect()} == {m: (n, plain.toxic[m]) for m, n in plain.texts.items()}
    assert plain.texts[""] == 400 and plain.toxic[""] == toxic.sum()


def test_emissions_add_the_weights_of_the_features():
    rng = random.Random(5)
    tokens = ["", "a", "Bad.", "BADLY", "«badness»", "É", "...", "abcdefghijklmnop", "l=3", "Bad", "bad"]
    names = sorted({f for t in tokens for f in token_features(t)})
    model = tx.Model({f: rng.uniform(-1, 1) for f in names if rng.random() < 0.8}, bias=0.3)
    for t in tokens:
        assert np.isclose(tx.Emissions(model).of(t), 0.3 + sum(model.weights.get(f, 0.0) for f in token_features(t)))
        assert tx.marks_of(t) == [f for f in token_features(t) if f[:2] == "w=" or f[:2] == "b=" and len(f) >= 6]


def test_tagger_forgets_in_generations(monkeypatch):
    texts, toxic = corpus(400, 7)
    model = tx.fit(texts, toxic)
    whole = tx.Tagger(model).tag(texts)[1]
    monkeypatch.setattr(tx, "CACHE_TOKENS", 20)
    small = tx.Tagger(model)
    parts = [p for i in range(0, 400, 7) for p in small.tag(texts[i : i + 7])[1]]
    assert small.tokens.elder and all(np.allclose(a, b) for a, b in zip(whole, parts))


def test_marks_are_handed_on_in_parts(spark, monkeypatch):
    texts, toxic = corpus(200, 8)
    monkeypatch.setattr(tx, "MARKS_HELD", 50)
    table = spark.createDataFrame([(str(i), t, bool(y)) for i, (t, y) in enumerate(zip(texts, toxic))], "key string, said string, toxic boolean")
    want = Counter(m for t in texts for m in {"", *(m for w in t.split() for m in tx.marks_of(w))})
    assert {r.mark: r.n for r in tx.mark_counts(table).collect()} == want


def test_sample_in_one_pass_equals_the_shares(spark, monkeypatch):
    texts, toxic = corpus(600, 9)
    rows = [(str(i), t, bool(y)) for i, (t, y) in enumerate(zip(texts, toxic))]
    table = spark.createDataFrame(rows, "key string, said string, toxic boolean").repartition(3)
    monkeypatch.setattr(tx, "MARKED_SEQUENCES", 40)
    monkeypatch.setattr(tx, "PLAIN_SEQUENCES", 100)
    marks = {"w=blarg": 30, "w=zounds": 25, "b=fieg": 60}
    strata = tx.Strata(marks)
    split = [(k, n, s, own) for k, t, y in rows for n, (s, own) in enumerate(strata.split(t, y))]
    sizes = Counter(s for _, _, s, _ in split)
    part = tx.shares(sizes)
    sample, counted = tx.sampled_sequences(table, marks, 600, int(toxic.sum()))
    assert counted == sizes
    assert sorted(sample) == sorted((s, own) for k, n, s, own in split if tx.lot(k, n) < part[s])


def test_scores_with_one_tagging_equal_those_in_two_steps(spark):
    texts, toxic = corpus(500, 10)
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string, most double")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)], "doc_id long, toxic int")
    usable = F.col("doc_id") % 4 != 2
    model = tx.learn(docs, labels, usable)
    two = {r.doc_id: (r.score, r.spans) for r in tx.score_texts(docs, model).collect()}
    one = {r.doc_id: (r.score, r.spans) for r in tx.learn_and_score(docs, labels, usable).collect()}
    assert one.keys() == two.keys() and all(np.isclose(one[k][0], two[k][0]) and one[k][1] == two[k][1] for k in one)
    assert np.allclose([two[i][0] for i in range(500)], model.score(*tx.summaries(tx.Tagger(model).tag(texts)[1])))


def test_spans():
    assert tx.spans_of("a bad  bad, b", np.array([0, 1, 1, 0], bool)) == [{"start": 2, "end": 11}]


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 0), (2, 0)], [(1, 1)]])
def test_without_both_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b", 0.0), (2, None, 0.0), (None, "", 0.0), (2, "x " * 3000, 0.0)], "doc_id long, text string, score double")
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = tx.score_texts(docs, model).collect()
    assert len(rows) == 4 and len({r.score for r in rows}) == 1
    assert tx.score_texts(docs.limit(0), model).count() == 0


def test_query_on_held_out_rows(spark, sf_small):
    import zlib

    from lakemart.llm.queries import op3_toxicity

    rows = {r.doc_id: r for r in op3_toxicity(spark, sf_small).collect()}
    assert rows.keys() == {r.doc_id for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    labels = [r for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[r.doc_id].predicted == r.toxic for r in labels]) > 0.8
