"""Components against brute force over full shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from lakemart.llm import components
from lakemart.llm import minhash as mh
from lakemart.llm.components import connected_components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent=85):
    """doc_id -> (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    tried = set()
    for ids in by_shingle.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    shared = len(sets[a] & sets[b])
                    if 100 * shared >= percent * len(sets[a] | sets[b]):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def variants(seed, size, words=120, edits=3):
    """A base and copies of it with a few words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(size - 1):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_shingles():
    s = mh.Shingler()
    assert len(s.shingles("")) == len(s.shingles(" \n\x0b")) == 0
    assert (s.shingles("A b\tC d e f") == s.shingles("a B c D e F")).all()
    assert len(s.shingles("a b c d e f a b c d e")) == len(shingles("a b c d e f a b c d e"))
    assert s.shingles("É b") != s.shingles("é b")  # only A-Z are lower-cased
    assert s.shingles("a b") != s.shingles("a  b c")


def test_exact_similarity_of_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(30)]
    got = mh._similar_sets(60)([s.astype(np.int64).tobytes() for s in sets], [len(s) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == (100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b)))


def test_forest():
    near = np.eye(5, dtype=bool)
    near[0, 3] = near[3, 0] = near[3, 4] = near[4, 3] = True
    assert sorted(mh._forest([9, 2, 7, 5, 6], near)) == [(5, 6), (5, 9)]


def test_minhash_estimates():
    rng = np.random.default_rng(0)
    base = rng.integers(1 << 62, size=4000, dtype=np.uint64)
    rows = mh.minhashes([base[:3000], base[1000:], base[:3000]])
    assert (rows[0] == rows[2]).all()
    assert abs((rows[0] == rows[1]).mean() - 0.5) < 0.25


@pytest.mark.parametrize("hot", [500, 5])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT", hot)  # the star below has more neighbours than that, or fewer
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(1000, k) for k in range(1001, 1400)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    frame = spark.createDataFrame([(b, a) for a, b in edges] + [(None, 1), (3, 3)], "a long, b long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {i: root(i) for i in parent if root(i) != i}


@pytest.mark.parametrize("block", [512, 7])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(mh, "SKETCH_BLOCK", block)  # small blocks: units across blocks
    monkeypatch.setattr(mh, "SET_BLOCK", block)
    rows = []
    for seed, size in ((1, 40), (2, 2), (3, 25), (4, 6)):
        rows += variants(seed, size)
    rows += [f"alone {k} " + " ".join(variants(100 + k, 1, 60)) for k in range(20)] + ["a b c", "A b c", "a b", "", None, rows[0], rows[0]]
    random.Random(9).shuffle(rows)
    data = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id long, text string, component int").repartition(3)
    assert got(mh.near_duplicates(docs)) == brute(data)


def test_banding_keeps_the_miss_chance():
    assert mh.banding(85) == mh.Banding(10, 22)
    for percent in range(mh.LEAST_PERCENT, 100):
        b, s = mh.banding(percent), percent / 100
        assert 2 * (1 - s**mh.PER_HALF) ** b.halves <= mh.MISS_TABLES
        equal = np.random.default_rng(percent).binomial(b.hashes, s, 100_000)
        assert (equal < b.least_equal).mean() <= 1e-4  # at the former constants 0.2 at 60
        assert b.hashes < 256
    for percent in (0, 49, 101):
        with pytest.raises(ValueError):
            mh.banding(percent)


@pytest.mark.parametrize("percent", [60, 80])
def test_low_limits_equal_brute_force(spark, percent):
    rng, rows = random.Random(percent), []
    for g in range(60):  # pairs just above the limit: one run of words differs
        words = [f"g{g}w{k}" for k in range(204)]
        shared = -(-2 * 200 * percent // (100 + percent))
        other = [w if k < shared + 4 else f"y{g}k{k}" for k, w in enumerate(words)]
        rows += [" ".join(words), " ".join(other)]
    rng.shuffle(rows)
    data = list(enumerate(rows))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    want = brute(data, percent)
    assert len({c for _, c in want.values()}) == 60
    assert got(mh.near_duplicates(docs, percent=percent)) == want


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in mh.near_duplicates(docs).collect())
    assert rows == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 0, "2", True), ("None", 2, "None", True)]
    assert mh.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_rows_that_share_an_id_have_one_set(spark, parts):
    """Whatever the partitions: the row of the least set hash stands for the id, in its links too."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "xyz")
    rows = [(1, a), (2, b), (2, a), (3, b), (4, c), (4, None), (5, c), (6, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    hashes = {t: mh._set_hash(mh.Shingler().shingles(t)) for t in (a, b, c)}
    with_two = 1 if hashes[a] < hashes[b] else 3
    want = {1: 1, 2: min(2, with_two), 3: 3, 4: 4, 5: 4, 6: 6}
    if with_two == 3:
        want[3] = 2
    got_ = {(r.doc_id, r.component_id) for r in mh.near_duplicates(docs).collect()}
    assert got_ == set(want.items())
    assert sorted(r.n_shingles for r in mh.near_duplicates(docs).collect()) == sorted(len(shingles(t)) for _, t in rows)


def test_ids_are_whole_numbers(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        mh.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    docs = spark.createDataFrame([(7, "a b c"), (3, "a b c")], "doc_id int, text string")
    assert got(mh.near_duplicates(docs)) == {7: (1, 3), 3: (1, 3)}


def test_query_equals_brute_force(spark, sf_small):
    from lakemart.llm.queries import op5_minhash

    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert got(op5_minhash(spark, sf_small)) == brute(data)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_made_by_an_explode_are_not_broadcast(spark, tmp_dir):
    # a file of a few bytes for each node, of which the half keys make twenty rows each: Spark takes them for small
    nodes = spark.range(50).selectExpr("id AS node", f"transform(sequence(1, {mh.HASHES}), k -> cast(k * (id % 5) AS int)) AS signature")
    nodes.write.parquet(f"{tmp_dir}/nodes")
    keys = mh._table_keys(spark.read.parquet(f"{tmp_dir}/nodes"), mh.banding(85).halves)
    assert "Broadcast" not in planned(keys)
    assert keys.select("node").distinct().count() == 50


def test_rounds_of_components_broadcast_counted_sides_only(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (9, 8)], "a long, b long")
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    least = components._least_neighbours(both)
    assert "Broadcast" not in planned(components._large_star(both, least))
    assert "Broadcast" not in planned(components._small_star(edges))
