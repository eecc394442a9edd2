"""Near duplicates by MinHash with tensored banding, verified on full shingle sets.

Two collections of half keys, each half made of ``PER_HALF`` minhashes, give a
table for each pair of them: the key of table (i, j) joins half i of the first
collection with half j of the second. At 0.85, 40 minhashes thus serve 100
tables of four. A pair of similarity s meets in a table unless all halves of one
side differ: the chance to miss it is below ``2 * (1 - s**PER_HALF) ** halves``.
``banding`` derives the number of halves from the limit so that this stays
below ``MISS_TABLES`` (10 halves at 0.85, 12 at 0.8, 43 at 0.5); limits below
``LEAST_PERCENT`` are refused.

1. Documents with the same shingle set become one node.
2. Half keys that occur once are dropped before they are joined to table keys;
   tables that hold the same nodes are looked at once.
3. Within a bucket, nodes are compared by one byte of each of their minhashes;
   enough equal ones (22 of 40 at 0.85; as many as miss a pair at the limit with
   a chance below ``MISS_SKETCH``) put two nodes into one cluster. What is passed
   on is a spanning forest, not pairs.
4. Within a cluster, full sets are compared, all pairs of them; again a
   spanning forest of the links is passed on, whose connected components are
   the result.

Buckets and clusters are compared in units of two blocks of bounded size, each
unit in its own group of rows, so that a very large group is spread over tasks
and no task holds more than two blocks. Rows grow with a group's size times
its number of blocks; only the comparison itself, which different variants of
one text near the limit can't do without, grows with the square.

Defined cases: null and empty texts have no shingles and are linked with
nothing; fewer than five words form one shingle; null ids have no component
and are kept; ids are whole numbers (others are refused); rows that share an id
count as one document, whose set is that of the row with the smallest hash of
its set (a row without shingles only if all are); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_KEYS, shuffled, slices, store, texts_of
from .components import connected_components

WORDS = 5
PER_HALF = 2
#: Most allowed chance that a pair at the limit meets in no table, and that it has too few equal minhashes.
MISS_TABLES = 1e-5
MISS_SKETCH = 2e-6
#: Lowest similarity limit that is served, in percent; tables grow fast below it.
LEAST_PERCENT = 50
#: Most nodes of a block when sketches, and when sets are compared; most shingles of the latter.
SKETCH_BLOCK = 2048
SET_BLOCK = 512
SET_BLOCK_SHINGLES = 1_000_000
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class Banding:
    """Half keys of each collection, and equal minhashes that put two nodes of a bucket into one cluster."""

    halves: int
    least_equal: int

    @property
    def hashes(self) -> int:
        return 2 * self.halves * PER_HALF


def banding(percent: int) -> Banding:
    """The fewest halves, and the most equal minhashes asked for, that keep both miss chances at ``percent`` similarity."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100, not {percent}")
    s = percent / 100
    halves = next(h for h in itertools.count(1) if 2 * (1 - s**PER_HALF) ** h <= MISS_TABLES)
    n, fewer, least = 2 * halves * PER_HALF, 0.0, 0  # fewer: P(at most ``least`` of n minhashes are equal)
    while least < n and (fewer := fewer + math.comb(n, least) * s**least * (1 - s) ** (n - least)) <= MISS_SKETCH:
        least += 1
    return Banding(halves, least)


HASHES = banding(85).hashes
_MOST_HASHES = banding(LEAST_PERCENT).hashes
_rng = np.random.default_rng(20240611)
_FACTORS = _rng.integers(1 << 62, size=_MOST_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1 << 62, size=_MOST_HASHES, dtype=np.uint64)
_PLACES = _rng.integers(1 << 62, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ x >> np.uint64(29)


class Shingler:
    """64-bit hashes of the distinct word shingles of a text, sorted."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # on bytes: A-Z and ASCII white space only
        if not words:
            return np.empty(0, np.uint64)
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.array([known[w] for w in words], np.uint64)
        n = len(ids)
        if n < WORDS:
            return _mixed(np.array([xxhash.xxh3_64_intdigest(ids.tobytes(), n)], np.uint64))
        total = ids[: n - WORDS + 1] * _PLACES[0]
        for k in range(1, WORDS):
            total += ids[k : n - WORDS + 1 + k] * _PLACES[k]
        return np.unique(_mixed(total))


def minhashes(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """One row of 32-bit minhashes for each non-empty set."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), hashes), np.int32)
    for k in range(hashes):
        values = (flat * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(values, starts).astype(np.uint32).view(np.int32)
    return out


def _set_hash(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _matrix(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(rows.reshape(-1), kind))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: int = HASHES) -> DataFrame:
    """``id_col, n_shingles, set_hash, signature``; the last two are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, text_col):
            sets = [shingler.shingles(t or "") for t in batch.column(text_col).to_pylist()]
            full = [s for s in sets if len(s)]
            made = iter(_matrix(minhashes(full, hashes), pa.int32()) if full else [])
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column(id_col),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_hash": pa.array([_set_hash(s) for s in sets], pa.binary()),
                    "signature": pa.array([next(made) if len(s) else None for s in sets], pa.list_(pa.int32())),
                }
            )

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()), T.StructField("signature", T.ArrayType(T.IntegerType()))]
    return docs.select(id_col, text_col).mapInArrow(run, T.StructType([docs.schema[id_col], *fields]))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, set_hash, data, size`` of each row: its set as the bytes of sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches, text_col):
            own = [shingler.shingles(t or "") for t in texts_of(batch, text_col)]
            sets = [np.sort(s.view(np.int64)) for s in own]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column(id_col),
                    "set_hash": pa.array([_set_hash(s) for s in own], pa.binary()),
                    "data": pa.array([s.tobytes() for s in sets], pa.binary()),
                    "size": pa.array([len(s) for s in sets], pa.int32()),
                }
            )

    fields = [T.StructField("set_hash", T.BinaryType()), T.StructField("data", T.BinaryType()), T.StructField("size", T.IntegerType())]
    out = T.StructType([T.StructField("node", docs.schema[id_col].dataType), *fields])
    return docs.select(id_col, text_col).mapInArrow(run, out)


def _table_keys(nodes: DataFrame, count: int) -> DataFrame:
    """``node, key, early``: table keys made of half keys that more than one node has.

    ``early`` marks the tables (i, i): one in ``count`` of all, which find most clusters.
    """
    halves = [F.xxhash64(F.lit(i), *(F.col("signature")[PER_HALF * i + k] for k in range(PER_HALF))) for i in range(2 * count)]
    rows = nodes.select("node", F.posexplode(F.array(*halves)).alias("half", "value"))
    shared = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    live = rows.join(shuffled(shared), "value").groupBy("node").agg(F.collect_list(F.struct("half", "value")).alias("own"))  # at most 2 * count to a node
    first = F.filter("own", lambda h: h["half"] < count)
    second = F.filter("own", lambda h: h["half"] >= count)
    pairs = live.select("node", F.explode(first).alias("x"), second.alias("ys")).select("node", "x", F.explode("ys").alias("y"))
    return pairs.select("node", F.xxhash64("x.value", "y.value").alias("key"), (F.col("x.half") + count == F.col("y.half")).alias("early"))


def _buckets(keys: DataFrame) -> DataFrame:
    """``grp, node, known, blocks``: buckets whose nodes are not known to be one component."""
    # tables that hold the same nodes (by number, ends and a hash of all) need one look
    kinds = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("all"),
        F.min("known").alias("least"), F.max("known").alias("most"),
    )
    one = kinds.filter("least <> most").groupBy("n", "low", "high", "all").agg(F.min("key").alias("key")).select("key", "n")
    return keys.join(shuffled(one), "key").select(F.col("key").alias("grp"), "node", "known", F.ceil(F.col("n") / SKETCH_BLOCK).cast("int").alias("blocks"))


def _in_units(rows: DataFrame) -> DataFrame:
    """Rows ``grp, node, known, blocks, data, size`` given to each unit ``(grp, one, two)`` that compares the node's block with another."""
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = spread.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other")).drop("other", "blocks")
    units = units.select("grp", "one", "two", "known", "own", "data", "size")
    return units.repartition("grp", "one", "two").sortWithinPartitions("grp", "one", "two", "own")


def _forest(known: list[int], near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the components ``known`` before within each component of the matrix ``near``."""
    left, out = np.ones(len(known), bool), []
    for i in range(len(known)):
        if not left[i]:
            continue
        found = np.zeros(len(known), bool)
        found[i] = True
        edge = found
        while edge.any():
            edge = near[edge].any(axis=0) & ~found
            found |= edge
        left &= ~found
        low, *others = sorted({known[k] for k in np.flatnonzero(found)})
        out += [(low, n) for n in others]
    return out


def _equal_bytes(bands: Banding):
    def equal_bytes(sketches: list[bytes], _: list[int]) -> np.ndarray:
        """Which sketches share enough bytes."""
        table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), bands.hashes)
        equal = np.zeros((len(table), len(table)), np.uint8)  # at most 172 minhashes
        for k in range(bands.hashes):
            equal += table[:, k][:, None] == table[:, k][None, :]
        return equal >= bands.least_equal

    return equal_bytes


def _similar_sets(percent: int):
    def similar(sets: list[bytes], sizes: list[int]) -> np.ndarray:
        """Which sets (bytes of sorted 64-bit hashes) are similar enough, by exact intersections."""
        flat = np.frombuffer(b"".join(sets), np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, number, often = np.unique(flat, return_inverse=True, return_counts=True)
        shared = often > 1  # what one set alone has adds to no intersection
        column = np.cumsum(shared) - 1
        keep = shared[number]
        rows, columns = owner[keep], column[number[keep]]
        order = np.argsort(columns, kind="stable")
        rows, columns = rows[order], columns[order]
        both = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2^24 are exact
        for start in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(columns, [start, start + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[rows[a:b], columns[a:b] - start] = 1
            both += part @ part.T
        n = np.array(sizes, np.float64)
        return 100 * both.astype(np.float64) >= percent * (n[:, None] + n[None, :] - both)

    return similar


def _unit_edges(near):
    """Edges ``a, b`` of a spanning forest of each unit; in units of two blocks only pairs across them count."""

    def unit(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        known, blocks, data, sizes = zip(*rows)
        matrix = near(list(data), list(sizes))
        if key[1] != key[2]:
            side = np.array(blocks)
            matrix &= side[:, None] != side[None, :]
        return _forest(list(known), matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("grp", "one", "two", "known", "own", "data", "size")))

        edges: list[tuple[int, int]] = []
        for key, rows in itertools.groupby(stream(), key=lambda r: r[:3]):
            edges += unit(key, [r[3:] for r in rows])
            if len(edges) > 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip("ab", (pa.array(c, pa.int64()) for c in zip(*edges)))))
                edges = []
        if edges:
            yield pa.RecordBatch.from_pydict(dict(zip("ab", (pa.array(c, pa.int64()) for c in zip(*edges)))))

    return run


def _clusters(nodes: DataFrame, bands: Banding) -> DataFrame:
    """``node, component`` of the nodes that share a bucket and most of a sketch with another.

    The early tables come first; of the others, only buckets that hold several
    of the components found then are looked at, and only edges between these
    are passed on.
    """
    # one byte of each minhash: enough to count equal ones
    sketches = nodes.select("node", F.col("sketch").alias("data"), F.lit(bands.hashes).alias("size"))
    keys = store(_table_keys(nodes, bands.halves))

    def edges(own: DataFrame) -> DataFrame:
        return _in_units(_buckets(own).join(shuffled(sketches), "node")).mapInArrow(_unit_edges(_equal_bytes(bands)), "a long, b long")

    early = store(connected_components(edges(keys.filter("early").withColumn("known", F.col("node")))))
    late = keys.filter(~F.col("early")).join(shuffled(early), "node", "left").withColumn("known", F.coalesce("component", "node"))
    found = edges(late.select("node", "key", "known"))
    moved = store(connected_components(found.unionByName(early.select(F.col("node").alias("a"), F.col("component").alias("b")))))
    return moved.unionByName(moved.select(F.col("component").alias("node"), "component").distinct())


def _links(clusters: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """``a, b``: links between full sets, a spanning forest of each unit."""
    wanted = store(clusters.join(shuffled(nodes.select("node", "n_shingles", "set_hash")), "node"))
    ids = wanted.select(F.col("node").alias(id_col)).distinct()
    if ids.count() <= BROADCAST_KEYS:
        ids = F.broadcast(ids)
    sets = shingle_sets(docs.select(id_col, text_col).join(ids, id_col, "left_semi"), id_col, text_col)
    sets = sets.join(shuffled(wanted.select("node", "set_hash").distinct()), ["node", "set_hash"], "left_semi").dropDuplicates(["node"])  # equal rows
    sets = sets.drop("set_hash")
    totals = wanted.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / SET_BLOCK), F.ceil(F.col("total") / SET_BLOCK_SHINGLES)).cast("int")
    # few components have several blocks; their rows, most of a task where one is hot, are left where they are
    large = store(totals.select("component", blocks.alias("blocks")).filter("blocks > 1"))
    large = F.broadcast(large) if large.count() <= BROADCAST_KEYS else shuffled(large)
    placed = wanted.select("node", "component").join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    units = _in_units(placed.withColumnRenamed("component", "grp").withColumn("known", F.col("node")).join(shuffled(sets), "node"))
    return units.mapInArrow(_unit_edges(_similar_sets(percent)), "a long, b long")


def _one_set_each(signed: DataFrame, id_col: str) -> DataFrame | None:
    """The row of each id that stands for it, if any id has several rows with different sets."""
    several = signed.groupBy(id_col).agg(F.count_distinct("set_hash").alias("sets"), F.count(F.lit(1)).alias("rows"), F.count("set_hash").alias("full"))
    if several.filter(f"`{id_col}` is not null and (sets > 1 or sets = 1 and full < rows)").isEmpty():
        return None
    order = F.struct(F.col("set_hash").isNull().alias("none"), "set_hash", "n_shingles", "signature")
    return store(signed.groupBy(id_col).agg(F.min(order).alias("one")).select(id_col, "one.set_hash", "one.n_shingles", "one.signature"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of each row, links at ``percent`` similarity or more."""
    bands = banding(percent)
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"{id_col} must be a column of whole numbers")
    signed = store(signatures(docs, id_col, text_col, bands.hashes))
    chosen = _one_set_each(signed, id_col)
    low_bytes = F.unhex(F.concat(*(F.lpad(F.hex(F.col("signature")[k].bitwiseAND(255)), 2, "0") for k in range(bands.hashes))))
    classes = store(
        (signed if chosen is None else chosen)
        .filter(f"`{id_col}` is not null and set_hash is not null")
        .groupBy("set_hash")
        .agg(F.min(F.col(id_col).cast("long")).alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
        .withColumn("sketch", low_bytes)
    )
    links = connected_components(_links(_clusters(classes, bands), classes, docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col, percent))

    def placed(rows: DataFrame) -> DataFrame:
        """``rows`` with the node of their set and its component."""
        return rows.join(shuffled(classes.select("set_hash", "node")), "set_hash", "left").join(shuffled(links), "node", "left")

    if chosen is None:
        ids = placed(signed.select(id_col, "n_shingles", "set_hash"))
    else:
        own = placed(chosen.select(id_col, "set_hash")).select(F.col(id_col).alias("own_id"), "component", "node")
        ids = signed.select(id_col, "n_shingles").join(shuffled(own), F.col(id_col) == F.col("own_id"), "left")
    component = F.when(F.col(id_col).isNotNull(), F.coalesce("component", "node", id_col))
    return ids.select(id_col, "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` without the near copies of a document with a smaller id; null ids stay."""
    linked = near_duplicates(docs, id_col, text_col, percent)
    dropped = store(linked.filter(~F.col("kept")).select(id_col).distinct())
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
