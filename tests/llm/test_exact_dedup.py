"""Fingerprints, comparison and grouping of equal texts."""

from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from lakemart.llm import exact_dedup as ed


def units(data):
    return [int.from_bytes(data[i : i + 2].ljust(2, b"\0"), "little") for i in range(0, len(data), 2)]


@given(st.binary(max_size=300))
def test_fingerprint_is_the_polynomial(data):
    want = []
    for base, prime in zip(ed.BASES, ed.PRIMES):
        h = 0
        for u in units(data):
            h = (h * base + u) % prime
        want.append(h)
    assert ed.fingerprint(data) == want[0] << 31 | want[1]


def test_parts_combine():
    whole = bytes(range(256)) * 200  # several chunks and a rest
    for cut in (2, 8192, 16384, 20000):
        a, b = ed.fingerprint(whole[:cut]), ed.fingerprint(whole[cut:])
        for which, shift in ((0, 31), (1, 0)):
            part = lambda x: x >> shift & (2**31 - 1)
            assert ed.combine(part(a), part(b), (len(whole) - cut + 1) // 2, which) == part(ed.fingerprint(whole))


def test_same_text():
    big = b"x" * 200_000
    assert ed.same_text(big, b"x" * 200_000)
    assert not ed.same_text(big, big[:-1] + b"y")
    assert not ed.same_text(b"", b"a")


ROWS = [(1, "a", 5), (2, "a", 6), (3, None, 7), (4, "", 8), (5, "b", 9), (None, "a", 1), (2, "a", 6), (6, "z" * 50_000, 1), (7, "z" * 50_000, 1)]
SCHEMA = "doc_id long, text string, members_ int"


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, top[t or ""], len(groups[t or ""]), i == top[t or ""]) for i, t, _ in rows), key=str)


def test_groups(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for cache in (ed.CACHE_BYTES, 4):  # with and without room to compare inside a task
        got = sorted((tuple(r) for r in ed.exact_dedup(docs, cache_bytes=cache).collect()), key=str)
        assert got == expected(ROWS)
        kept = ed.keep_largest(docs, cache_bytes=cache)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 7]
    assert ed.exact_dedup(docs.limit(0)).count() == 0


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    import pyarrow as pa

    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("f", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("first", pa.bool_())])
    batch = pa.record_batch([pa.array([4, 3, 2, 1]), pa.array(["x", "y", "x", "y"]), pa.array([9] * 4), pa.array([1] * 4)], names=["doc_id", "text", "f", "n"])

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(ed, "TaskContext", Context)
    (got,) = ed._classes("text", "f", "n", "c", "first", out)(iter([batch]))
    assert got.column("c").to_pylist() == [1, 2, 1, 2]
    assert got.column("first").to_pylist() == [True, True, False, False]
