"""Exact duplicates by composable polynomial fingerprints and chunkwise comparison.

A text's fingerprint is a pair of polynomials over its 16-bit units, modulo two
primes. Chunks are hashed on their own (one matrix product for all full chunks
of a huge text) and joined by shifting: ``H(xy) = H(x) * B^|y| + H(y)``.
Fingerprints only bring texts together; equality is decided by comparing the
texts chunk by chunk.

Work is split so that no group of copies meets in one task. Each map task
compares its own rows first and passes on one row per distinct text with the
list of its members; the shuffle by fingerprint then brings at most a few rows
per map task to a group, however many copies there are.

Defined cases: a null text is empty, empty texts are equal to each other, a
null id is smaller than any other, and of rows with equal text and equal id
``keep_largest`` returns one while ``exact_dedup`` marks each as kept. An empty
table gives an empty result. Other columns are ignored by ``exact_dedup`` and
passed through by ``keep_largest``, whatever their names.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, store

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_249, 1_664_525_003)
CHUNK_UNITS = 4096
COMPARE_BYTES = 1 << 16
#: Bytes of text that a map task keeps for comparing its own rows.
CACHE_BYTES = 32_000_000


def _powers(base: int, prime: int) -> np.ndarray:
    out, x = np.empty(CHUNK_UNITS, np.uint64), 1
    for i in range(CHUNK_UNITS - 1, -1, -1):
        out[i] = x
        x = x * base % prime
    return out


_POWERS = [_powers(b, p) for b, p in zip(BASES, PRIMES)]


def combine(left: int, right: int, right_units: int, which: int) -> int:
    """Hash of two parts from the hashes of each; ``right_units`` long is the second."""
    prime = PRIMES[which]
    return (left * pow(BASES[which], right_units, prime) + right) % prime


def fingerprint(data: bytes) -> int:
    """62-bit fingerprint of ``data``; odd lengths are padded (the length is compared too)."""
    if len(data) % 2:
        data += b"\0"
    units = np.frombuffer(data, "<u2").astype(np.uint64)
    full = len(units) // CHUNK_UNITS * CHUNK_UNITS
    parts = []
    for which, prime in enumerate(PRIMES):
        h = 0
        if full:
            shift = pow(BASES[which], CHUNK_UNITS, prime)
            # 4096 products below 2^47 stay below 2^59
            for c in (units[:full].reshape(-1, CHUNK_UNITS) @ _POWERS[which] % prime).tolist():
                h = (h * shift + c) % prime
        if rest := len(units) - full:
            tail = int(units[full:] @ _POWERS[which][-rest:]) % prime
            h = combine(h, tail, rest, which)
        parts.append(h)
    return parts[0] << 31 | parts[1]


def same_text(a: bytes, b: bytes) -> bool:
    """Compare chunk by chunk, stopping at the first that differs."""
    if len(a) != len(b):
        return False
    x, y = memoryview(a), memoryview(b)
    return all(x[i : i + COMPARE_BYTES] == y[i : i + COMPARE_BYTES] for i in range(0, len(a), COMPARE_BYTES))


def _above(a, b) -> bool:
    return b is None and a is not None or a is not None and b is not None and a > b


def _distinct_in_task(names: list[str], id_col: str, text_col: str, out: pa.Schema, cache_bytes: int):
    """Map side: one row per distinct text seen by the task (bounded cache), with its members."""
    at, tx = names.index(id_col), names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: OrderedDict[int, list] = OrderedDict()  # uid -> [row, fp, bytes, members]
        by_fp: dict[tuple[int, int], list[int]] = {}
        held = uid = 0

        def emit(entries):
            rows = [e[0] + (e[1], len(e[2]), e[3]) for e in entries]
            cols = list(zip(*rows)) if rows else [[] for _ in out]
            return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(cols, out)], schema=out)

        for batch in batches:
            full = []
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                row = row[:tx] + (row[tx] or "",) + row[tx + 1 :]
                data = row[tx].encode()
                key = (fingerprint(data), len(data))
                for other in by_fp.get(key, ()):
                    entry = cache[other]
                    if same_text(entry[2], data):
                        entry[3].append(row[at])
                        if _above(row[at], entry[0][at]):
                            entry[0] = row
                        break
                else:
                    uid += 1
                    cache[uid] = [row, key[0], data, [row[at]]]
                    by_fp.setdefault(key, []).append(uid)
                    held += 2 * len(data)
                    while held > cache_bytes and len(cache) > 1:
                        old, entry = cache.popitem(last=False)
                        by_fp[entry[1], len(entry[2])].remove(old)
                        held -= 2 * len(entry[2])
                        full.append(entry)
            if full:
                yield emit(full)
        entries = list(cache.values())
        for i in range(0, len(entries), 256):
            yield emit(entries[i : i + 256])

    return run


def _classes(text_col: str, fp: str, n: str, cls: str, first: str, out: pa.Schema):
    """Reduce side: rows sorted by fingerprint stream past; only one text per class is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        key, refs, count = None, [], 0
        for batch in batches:
            ids, firsts = [], []
            for f, m, text in zip(*(batch.column(c).to_pylist() for c in (fp, n, text_col))):
                if (f, m) != key:
                    key, refs = (f, m), []
                data = text.encode()
                found = next((c for c, ref in refs if same_text(ref, data)), None)
                firsts.append(found is None)
                if found is None:
                    count += 1
                    found = base + count
                    refs.append((found, data))
                ids.append(found)
            cols = {c: batch.column(c) for c in batch.schema.names} | {cls: pa.array(ids, pa.int64()), first: pa.array(firsts)}
            yield pa.record_batch([cols[f.name].cast(f.type) for f in out], schema=out)

    return run


def _class_rows(docs: DataFrame, id_col: str, text_col: str, cache_bytes: int):
    """Rows (columns of the row with the largest id, members, class, first of its class)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = docs.columns
    fp, n, members, cls, first = (fresh(c, names) for c in ("fp_", "bytes_", "members_", "class_", "first_"))
    id_type = docs.schema[id_col].dataType
    mapped = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType()), T.StructField(n, T.LongType()), T.StructField(members, T.ArrayType(id_type))])
    local = docs.mapInArrow(_distinct_in_task(names, id_col, text_col, to_arrow_schema(mapped), cache_bytes), mapped)
    sent = local.repartition(fp, n).sortWithinPartitions(fp, n, F.col(id_col).desc_nulls_last())
    classed = T.StructType([*mapped.fields, T.StructField(cls, T.LongType()), T.StructField(first, T.BooleanType())])
    rows = sent.mapInArrow(_classes(text_col, fp, n, cls, first, to_arrow_schema(classed)), classed)
    return rows, members, cls, first


def keep_largest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """The rows of ``docs``, one for each distinct text: that with the largest id."""
    rows, _, _, first = _class_rows(docs, id_col, text_col, cache_bytes)
    return rows.filter(F.col(first)).select(*docs.columns)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_text: dict[str, Column] | None = None,
    cache_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept`` and the ``per_text`` columns.

    ``per_text`` are expressions over the text column, computed once for each
    distinct text.
    """
    slim = docs.select(F.col(id_col), F.col(text_col))
    rows, members, cls, first = _class_rows(slim, id_col, text_col, cache_bytes)
    extra = {k: F.when(F.col(first), v) for k, v in (per_text or {}).items()}
    stored = store(rows.select(id_col, members, cls, *(v.alias(k) for k, v in extra.items())))
    totals = stored.groupBy(cls).agg(
        F.max(id_col).alias("keep_id"),
        F.sum(F.size(members)).cast("long").alias("group_size"),
        *(F.max(k).alias(k) for k in extra),
    )
    return (
        stored.select(cls, members)
        .join(totals, cls)  # before members are spread out: a group has few rows here
        .select(F.explode(members).alias(id_col), "keep_id", "group_size", *extra)
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
        .select(id_col, "keep_id", "group_size", "kept", *extra)
    )
