"""Each stage of the pipeline against a plain reading of what it should do to its input."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline as cp
from tests.llm.test_minhash import brute as near_components


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    import os

    from lakemart.llm.common import documents, store
    from tests.conftest import SF_SMALL

    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not present")
    docs, out = documents(spark, SF_SMALL), {}
    out["documents"] = docs
    for name, stage in cp.STAGES:
        docs = store(stage(spark, docs, SF_SMALL))
        out[name] = docs
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "pii", "best_fit_packing"]
    for name, frame in list(stages.items())[:-1]:
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_quality_keeps_good_rows_whole(spark, stages):
    from tests.conftest import SF_SMALL

    before, after = by_id(stages["documents"]), by_id(stages["quality_classifier"])
    assert all(before[k] == r for k, r in after.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    good = [k for k, q in labels.items() if q == 1]
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in after for k in good) >= 0.97 * len(good)
    assert sum(k in after for k in bad) <= 0.2 * len(bad)


def test_exact(stages):
    before, after = by_id(stages["quality_classifier"]), by_id(stages["exact_dedup"])
    largest = {}
    for k, r in before.items():
        largest[r.text or ""] = max(k, largest.get(r.text or "", k))
    assert after == {k: before[k] for k in largest.values()}


def test_near(stages):
    before, after = by_id(stages["exact_dedup"]), by_id(stages["minhash_near_dedup"])
    components = near_components([(k, r.text) for k, r in before.items()], cp.NEAR_PERCENT)
    assert after == {k: before[k] for k, (_, c) in components.items() if c == k}


def test_near_links_from_80_percent(spark):
    rows = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(200)]
        for edits in (0, 3, 4, 5):  # similarity to the first: 0.858, 0.815, 0.774
            own = list(base)
            for e in range(edits):
                own[10 + 20 * e + 7 * edits] = f"x{g}e{edits}k{e}"
            rows.append((len(rows), " ".join(own), "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    components = near_components([(r[0], r[1]) for r in rows], 80)
    kept = set(by_id(cp.near_stage(spark, docs, "")))
    assert kept == {k for k, (_, c) in components.items() if c == k}
    assert kept != {k for k, (_, c) in near_components([(r[0], r[1]) for r in rows], 85).items() if c == k}


def test_pii(stages):
    before, after = by_id(stages["minhash_near_dedup"]), by_id(stages["pii"])
    assert before.keys() == after.keys()
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    changed = 0
    for k, r in after.items():
        assert not email.search(r.text or "")
        if email.search(before[k].text or ""):
            assert "<EMAIL>" in r.text
        if not re.search(r"[0-9@]|://", before[k].text or ""):
            assert r == before[k]
        changed += r != before[k]
    assert changed


def test_packing(stages):
    rows = stages["best_fit_packing"].collect()
    assert {r.doc_id for r in rows} == set(by_id(stages["pii"]))
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_null_ids_and_repeated_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(None, text, None, None, None), (None, "other " + text[::-1], None, None, None), (1, text, "en", "s", 3), (1, text, "en", "s", 3), (2, None, "en", None, 0)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert sorted(str(r.doc_id) for r in cp.run(spark, str(tmp_path)).collect()) == ["1", "2", "None"]
