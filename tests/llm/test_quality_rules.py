"""Counts against a plain reading of their definition, and the rule learner."""

from __future__ import annotations

import re
from collections import Counter as Bag

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import quality_rules as qr
from lakemart.llm.textstats import COUNTS, Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    windows = Bag(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    dup, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup, "n_repeat_words": len(covered)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\x0b", "\x1c", "　", "#", "|", "\r", "a b c "]), max_size=60).map("".join))
def test_counts(text):
    got = dict(zip(COUNTS, Counter().counts(text)))
    assert {k: got[k] for k in plain(text)} == plain(text)


def test_many_words_do_not_clash():
    words = np.array([1 << 21, 5, 6, 1 << 21, 5, 6, 7], np.int64)
    from lakemart.llm.textstats import repeated

    assert repeated(words) == 6


def test_learns_a_conjunction():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.4)
    rules = qr.learn(x, bad)
    told = np.logical_or.reduce([r.covers(x) for r in rules])
    assert (told == bad).mean() > 0.98
    assert all(len(r.conditions) <= 4 for r in rules)


def test_noise_gives_no_rules():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(600), "b": rng.random(600)}
    bad = rng.random(600) < 0.1
    rules = qr.learn(x, bad)
    assert not rules or np.logical_or.reduce([r.covers(x) for r in rules]).mean() < 0.05


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 1), (2, 1)]])
def test_without_both_classes_the_base_decides(spark, labels):
    docs = spark.createDataFrame([(1, "w " * 30, 0), (2, " ".join(f"w{i}" for i in range(80)), 0), (None, None, 0), (2, "", 0)], "doc_id long, text string, counts int")
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    rules = qr.learn_rules(docs, frame)
    assert rules == []
    got = sorted((str(r.doc_id), r.counts.n_words, r.base_failed, r.kept) for r in qr.apply_rules(docs, rules).collect())
    assert got == [("1", 30, True, False), ("2", 0, True, False), ("2", 80, False, True), ("None", 0, True, False)]
    assert qr.apply_rules(docs.limit(0), rules).count() == 0


def test_contradicting_labels_and_very_long_texts(spark):
    good = " ".join(f"word{i}" for i in range(90)) + "."
    rows = [(i, good if i % 2 else good + " | # $ |" * 40) for i in range(240)] + [(900, "lang " * 200_000 + good), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, i % 2) for i in range(240)]
    labels += [(1, 0), (1, 1), (0, 1), (0, 0), (0, 0)]  # the mean counts: row 1 is good, row 0 bad
    rules = qr.learn_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert rules == qr.learn_rules(docs.repartition(5), spark.createDataFrame(labels[::-1], "doc_id long, quality int"))
    got = {r.doc_id: r for r in qr.apply_rules(docs, rules).collect()}
    assert all(got[i].kept == bool(i % 2) for i in range(240))
    assert got[900].counts.n_words == 200_090 and got[900].base_failed and not got[900].kept
    assert got[901].counts.n_words == 0 and got[901].base_failed


def test_query(spark, sf_small):
    from lakemart.llm.queries import op2_quality_rules

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op2_quality_rules(spark, sf_small).collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        want = plain(text)
        assert {c: rows[k][c] for c in want} == want
        assert rows[k].base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (rows[k].base_failed and rows[k].kept)
    good = [r for r in spark.read.parquet(f"{sf_small}/labels.parquet").filter("quality = 1").collect() if not rows[r.doc_id].base_failed]
    assert np.mean([rows[r.doc_id].kept for r in good]) > 0.95
