"""Co-training on made-up views, and held-out accuracy on the tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import cotraining as ct


def views(n, seed):
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.8
    x = {c: rng.random(n) for c in dict.fromkeys(ct.CONTENT + ct.LAYOUT)}
    x["symbols_per_word"] = np.where(good, rng.random(n) * 0.3, 0.2 + rng.random(n))
    x["ended_line_share"] = np.where(good, 0.4 + rng.random(n) * 0.6, rng.random(n) * 0.7)
    return x | {c: rng.integers(0, 5, n) for c in ct.CATEGORIES}, good


def test_pool_helps_few_labels():
    labelled, y = views(60, 1)
    pool, _ = views(3000, 2)
    test, truth = views(2000, 3)
    accuracy = lambda m: ((m.scores(test)[0] >= 0.5) == truth).mean()
    taught = ct.co_train(labelled, y, pool)
    assert accuracy(taught) > 0.9
    assert accuracy(taught) >= accuracy(ct.co_train(labelled, y, pool, rounds=0)) - 0.01


def test_logistic_fit_is_stationary():
    rng = np.random.default_rng(0)
    a = np.hstack([np.ones((500, 1)), rng.normal(size=(500, 3))])
    y = (a @ [0.2, 1, -2, 0] + rng.normal(size=500) > 0).astype(float)
    w = ct.fit_logistic(a, y, ridge=0.5, rounds=50)
    gradient = a.T @ (y - 1 / (1 + np.exp(-a @ w))) - np.array([0, 0.5, 0.5, 0.5]) * w
    assert np.abs(gradient).max() < 1e-3


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1)]])
def test_edge_rows(spark, labels):
    docs = spark.createDataFrame([(1, None, None, 0.5), (2, "", "en", 0.5), (None, "a b.\n" * 2000, "en", 0.5), (2, "", "en", 0.5)], "doc_id long, text string, lang string, score double")
    model = ct.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = ct.score(docs, model).collect()
    assert len(rows) == 4 and all(r.kept for r in rows)
    kept = ct.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert ct.keep_good(docs.limit(0), model).count() == 0


def test_clashing_columns_and_contradicting_labels(spark):
    rows = [(i, "good words here.\n" * (i % 5 + 1) if i % 2 else "x# | $ " * 9, 1.0, "y", True, 7, [1], "s") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label_mean double, y string, held boolean, id int, counts array<int>, said string")
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(60)] + [(1, 0, "t"), (1, 1, "t"), (None, 1, "t")], "doc_id long, quality int, text string")
    model = ct.learn(docs, labels)
    kept = ct.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.collect()} == {1}
    assert {r.doc_id: r.kept for r in ct.score(docs, model).collect()} == {i: bool(i % 2) for i in range(200)}


def test_cut_takes_sure_rows_from_the_top():
    sure = int(ct._bins(np.array([np.log(9)]))[0]) + 1
    counts = np.zeros(2 * ct.MOST * ct.BINS)
    counts[[sure - 1, sure, sure + 5, sure + 9]] = 100, 3, 4, 2
    assert ct.cut(counts, 6, 0.9) == sure + 5 and ct.cut(counts, 9, 0.9) == sure
    assert ct.cut(counts, 1, 0.9) == sure + 9  # the first bin counts whole
    assert ct.cut(np.zeros(2 * ct.MOST * ct.BINS), 5, 0.9) == 2 * ct.MOST * ct.BINS


def test_steps_are_those_of_rows_at_hand(spark):
    """Sums made by Spark over several tasks and batches equal those over all rows together."""
    x, y = views(3000, 5)
    labelled = np.arange(3000) < 300
    rows = [(i, float(y[i]) if labelled[i] else None, bool(labelled[i] and i % 4 == 3), *(float(x[n][i]) for n in ct.NUMBERS), *(int(x[c][i]) for c in ct.CATEGORIES)) for i in range(3000)]
    schema = "id long, y double, held boolean, " + ", ".join([f"{n} double" for n in ct.NUMBERS] + [f"{c} int" for c in ct.CATEGORIES])
    features = spark.createDataFrame(rows, schema).repartition(5)
    model = ct.learn_from(features)
    x |= {"y": np.where(labelled, y.astype(float), np.nan), "held": labelled & (np.arange(3000) % 4 == 3)}
    edges = {n: model.content.edges.get(n, model.metadata.edges.get(n)) for n in ct.NUMBERS}
    here = ct.co_train_rows(lambda f: f(x), edges)
    for a, b in ((model.content, here.content), (model.metadata, here.metadata)):
        assert np.allclose(a.weights, b.weights, atol=1e-6) and np.allclose(a.calibration, b.calibration, atol=1e-6)
    truth, made = views(2000, 6)[1], ct.Model.scores(model, views(2000, 6)[0])[0]
    assert ((made >= 0.5) == truth).mean() > 0.9


def test_numpy_ratios_equal_the_columns(spark, sf_small):
    from lakemart.llm.textstats import EMPTY, Counter, ratio_arrays, ratios, text_counts

    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rows = text_counts(docs).select("doc_id", *(c.alias(n) for n, c in ratios().items())).orderBy("doc_id").collect()
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    counter = Counter()
    made = ratio_arrays([counter.counts(t) if t else EMPTY for t in texts])
    for n, values in made.items():
        assert [r[n] for r in rows] == values.tolist()


def test_held_out_accuracy(spark, sf_small):
    base = sf_small.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    model = ct.learn(docs, labels.filter(half == 0))
    rows = ct.score(docs, model).join(labels.filter(half == 1), "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.95
    good = [r.kept for r in rows if r.quality == 1]
    assert np.mean(good) > 0.97


def test_query_scores_every_row(spark, sf_small):
    from lakemart.llm.queries import op6_cotraining

    rows = op6_cotraining(spark, sf_small).collect()
    docs = [r.doc_id for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)
