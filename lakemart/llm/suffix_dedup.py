"""Repeated substrings by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if it lies in a string of ``length`` bytes (a window) that also
starts anywhere else. Sorting every suffix of a corpus would move each byte
``length`` times, so suffixes are sampled where the content says so: each window
is assigned to the least hash among its strings of ``length / 2`` bytes (its
anchor). Equal windows have equal anchors at equal places, hence a window whose
anchor occurs once cannot repeat, and windows in a row that share an anchor are
told apart together, as one suffix truncated behind the last of them.

1. Anchors are counted by hash; texts keep those that occur twice or more.
2. Each task sorts the suffixes of its anchors, folds equal ones, and sends
   them as front-coded runs: the length of the prefix shared with the suffix
   before, and the rest.
3. A receiving task merges its runs with a loser tree that keeps, for each
   run's head, how long a prefix it shares with the last output. Longer wins
   outright; only on a tie are bytes compared, from that length on. Equal
   suffixes meet next to each other: all their windows repeat.
4. Suffixes of one anchor that differ (where a repeated passage begins or ends)
   are compared window by window inside the task. An anchor that occurs more
   than ``HOT`` times, of a passage that very many texts share, is dealt out by
   content, and its windows are counted by fingerprint in a shuffle of their own.

Results go back by the hash and length of the text, so copies of a text are
worked on once. Windows within a task's group are told apart by 64-bit
fingerprints, those counted in the shuffle by two of them.

Defined cases: null and empty texts lose nothing; matches never cross texts;
overlaps count, also within a text; every copy of a repeated string goes,
repeated rows count as copies; null ids are passed through; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_KEYS, slices, store

LENGTH = 200
#: Occurrences beyond which an anchor's suffixes are dealt out by content.
HOT = 4000
#: Bytes of suffixes that a task sorts into one run, and that one target merges, about.
RUN_BYTES = 16_000_000
TARGET_BYTES = 64_000_000

_BITS = 20
_BLOCK = 1 << _BITS
_INDEX = np.uint64(_BLOCK - 1)
_BASE = 0x9E3779B97F4A7C15


#: Base of the second fingerprint of windows that are counted in a shuffle.
_OTHER = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    out, filled, step = np.ones(n, np.uint64), 1, base
    while filled < n:
        k = min(filled, n - filled)
        out[filled : filled + k] = out[:k] * np.uint64(step)
        filled, step = filled + k, step * step % (1 << 64)
    return out


_UP = _powers(_BASE, _BLOCK + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _BLOCK + 1)
_TABLES = {_BASE: (_UP, _DOWN), _OTHER: (_powers(_OTHER, 1 << 16), _powers(pow(_OTHER, -1, 1 << 64), 1 << 16))}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(32)


def window_hashes(data: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Hash of every string of ``size`` bytes; at most ``2**20`` bytes at once (``2**16`` for another base)."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _TABLES[base]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * up[: len(data)], out=sums[1:])
    return _mixed((sums[size:] - sums[:-size]) * down[:n])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by running minima from both ends of blocks."""
    padded = np.full(-(-len(x) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(x)] = x
    padded = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window of each run of windows with one anchor."""
    part = length // 2
    anchors, firsts, lasts = [], [], []
    for at in range(0, max(0, len(data) - length + 1), _BLOCK - length):
        block = np.frombuffer(data, np.uint8, min(len(data) - at, _BLOCK - 1), at)
        hashes = window_hashes(block, part)
        least = _sliding_min((hashes & ~_INDEX) | np.arange(len(hashes), dtype=np.uint64), length - part + 1)
        place = (least & _INDEX).astype(np.int64)[: _BLOCK - length]
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        anchors.append(hashes[place[first]].view(np.int64))
        firsts.append(first + at)
        lasts.append(np.append(first[1:] - 1, len(place) - 1) + at)
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(anchors), np.concatenate(firsts), np.concatenate(lasts)


# --- sorted runs ----------------------------------------------------------------


def _shared_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the prefix that each string shares with the one before."""
    out = np.zeros(len(strings), np.int64)
    for a in range(0, len(strings) - 1, 10_000):
        part = strings[a : a + 10_001]
        sizes = np.array([len(s) for s in part])
        table = np.zeros((len(part), sizes.max() + 1), np.uint8)
        table[np.arange(table.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(part), np.uint8)
        differs = table[1:] != table[:-1]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), table.shape[1])
        out[a + 1 : a + len(part)] = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return out


def front_coded(entries: list[tuple[bytes, int, bool, tuple]]) -> bytes:
    """A run from sorted (string, weight, hot, reference): equal strings are folded into one."""
    shared = _shared_prefixes([e[0] for e in entries])
    prefix, rest, weights, hot, counts, refs = [], [], [], [], [], []
    last = None
    for (string, weight, is_hot, ref), k in zip(entries, shared.tolist()):
        if last is not None and k == len(string) == len(last):
            weights[-1] += weight
            counts[-1] += 1
        else:
            prefix.append(k)
            rest.append(string[k:])
            weights.append(weight)
            hot.append(is_hot)
            counts.append(1)
            last = string
        refs.append(ref)
    columns = (np.array(prefix, np.uint16), np.array([len(r) for r in rest], np.uint16), b"".join(rest), np.array(weights, np.int64), np.array(hot), np.array(counts, np.int32), np.array(refs, np.int64).T)
    return zlib.compress(pickle.dumps(columns), 1)


def read_run(blob: bytes) -> Iterator[tuple[int, bytes, int, bool, np.ndarray]]:
    """(shared prefix, string, weight, hot, references) of each string of a run."""
    prefix, sizes, data, weights, hot, counts, refs = pickle.loads(zlib.decompress(blob))
    at = ref = 0
    string = b""
    for k, n, w, h, c in zip(prefix.tolist(), sizes.tolist(), weights.tolist(), hot.tolist(), counts.tolist()):
        string = string[:k] + data[at : at + n]
        yield k, string, w, h, refs[:, ref : ref + c]
        at, ref = at + n, ref + c


def _first_difference(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    end, step = min(len(a), len(b)), 16
    while start < end:
        if a[start : start + step] == b[start : start + step]:
            start += step
            step = 64
        elif step > 1:
            step = max(1, step // 4)
        else:
            return start
    return end


def merge_runs(blobs: list[bytes]) -> Iterator[tuple[int, bytes, int, bool, np.ndarray]]:
    """The strings of all runs in order, each with the prefix shared with the one before.

    A loser tree: a node keeps the run that lost there, and heads are compared
    by the prefix they share with the last output before any byte is looked at.
    """
    runs = [read_run(b) for b in blobs]
    n = 1 << max(0, (len(runs) - 1).bit_length())
    heads = [next(r, None) for r in runs] + [None] * (n - len(runs))
    known = [0] * n  # prefix that a run's head shares with the last output
    tree = [0] * n

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        s, t = x[1], y[1]
        k = _first_difference(s, t, known[a])
        first = k == len(s) or k < len(t) and s[k] < t[k]
        won, lost = (a, b) if first else (b, a)
        known[lost] = k
        return won, lost

    def build(node: int) -> int:
        if node >= n:
            return node - n
        won, lost = play(build(2 * node), build(2 * node + 1))
        tree[node] = lost
        return won

    top = build(1)
    while (head := heads[top]) is not None:
        yield known[top], *head[1:]
        heads[top] = following = next(runs[top], None)
        known[top] = following[0] if following is not None else 0
        node, won = (top + n) >> 1, top
        while node:
            won, tree[node] = play(won, tree[node])
            node >>= 1
        top = won


# --- what repeats ---------------------------------------------------------------


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


class _Found:
    """Rows for the result: covered ranges, and windows still to be counted."""

    NAMES = ("window", "other", "weight", "key", "bytes", "start", "end")

    def __init__(self, length: int):
        self.length, self.rows = length, []
        self.mixed: list[tuple[int, bytes, int, tuple]] = []  # (group, string, weight, reference) of anchors that differ
        self.size = 0

    def covered(self, key: int, size: int, start: int, end: int) -> None:
        self.rows.append((None, None, 0, key, size, start, end))

    def whole(self, string: bytes, refs: np.ndarray) -> None:
        for key, size, start in refs.T.tolist():
            self.covered(key, size, start, start + len(string))

    def fingerprints(self, string: bytes, weight: int, refs: np.ndarray) -> None:
        data = np.frombuffer(string, np.uint8)
        both = zip(*(window_hashes(data, self.length, base).view(np.int64).tolist() for base in (_BASE, _OTHER)))
        for i, h in enumerate(both):
            if weight > 1:
                self.rows.append((*h, 2, None, None, None, None))
            else:
                key, size, start = (int(v) for v in refs[:, 0])
                self.rows.append((*h, 1, key, size, start + i, start + i + self.length))

    def differing(self, group: int, string: bytes, weight: int, refs: np.ndarray) -> None:
        self.mixed.append((group, string, weight, tuple(refs[:, 0].tolist())))
        self.size += len(string)

    def settle(self) -> None:
        """Compare the windows of suffixes that share an anchor but differ."""
        if not self.mixed:
            return
        hashes, owner = [], []
        for i, (group, string, _, _) in enumerate(self.mixed):
            h = window_hashes(np.frombuffer(string, np.uint8), self.length)
            hashes.append(_mixed(h ^ np.uint64(group % (1 << 64))))
            owner.append(np.full(len(h), i))
        flat, own = np.concatenate(hashes), np.concatenate(owner)
        weights = np.minimum([m[2] for m in self.mixed], 2)
        _, number = np.unique(flat, return_inverse=True)
        again = (np.bincount(number, weights=weights[own]) >= 2)[number]
        ends = np.cumsum([len(h) for h in hashes])
        for (_, _, weight, (key, size, start)), a, b in zip(self.mixed, np.concatenate([[0], ends[:-1]]), ends):
            if weight == 1:
                for first, last in _ranges(again[a:b]):
                    self.covered(key, size, start + first, start + last + self.length)
        self.mixed, self.size = [], 0

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(self.NAMES)
        self.rows = []
        return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(self.NAMES, columns)})


def _merge(length: int):
    """Merge the runs of each target and report what repeats."""

    def target_rows(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = _Found(length)
        group, held, several = None, None, False  # of the current anchor: its first suffix, whether another came
        current = None  # suffix whose copies are being gathered: [anchor, string, weight, hot, references]

        def close(entry) -> None:
            nonlocal group, held, several
            anchor, string, weight, hot, refs = entry
            body, refs = string[8:], np.hstack(refs)
            if weight > 1:
                found.whole(body, refs)
            if hot:
                found.fingerprints(body, weight, refs)
                return
            if anchor != group:
                group, held, several = anchor, (body, weight, refs), False
                if found.size > 2_000_000:
                    found.settle()  # the anchors before are complete
                return
            if not several:
                found.differing(group, *held)
                several = True
            found.differing(group, body, weight, refs)

        for shared, string, weight, hot, refs in merge_runs(blobs):
            if current is not None and shared == len(string) == len(current[1]):
                current[2] += weight
                current[4].append(refs)
                continue
            if current is not None:
                close(current)
                if len(found.rows) > 20_000:
                    yield found.batch()
            current = [int.from_bytes(string[:8], "big"), string, weight, hot, [refs]]
        if current is not None:
            close(current)
        found.settle()
        yield found.batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, blobs = None, []
        for batch in batches:
            for t, blob in zip(batch.column("target").to_pylist(), batch.column("run").to_pylist()):
                if t != target and blobs:
                    yield from target_rows(blobs)
                    blobs = []
                target = t
                blobs.append(blob)
        if blobs:
            yield from target_rows(blobs)

    return run


def _sorted_runs(length: int, targets: int):
    """Runs for each target from texts with the anchors that occur more than once."""

    def flush(entries: list) -> pa.RecordBatch:
        entries.sort(key=lambda e: (e[0], e[1]))
        out, a = [], 0
        while a < len(entries):
            b = a
            while b < len(entries) and entries[b][0] == entries[a][0]:
                b += 1
            out.append((entries[a][0], front_coded([e[1:] for e in entries[a:b]])))
            a = b
        return pa.RecordBatch.from_pydict({"target": pa.array([t for t, _ in out], pa.int32()), "run": pa.array([r for _, r in out], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0
        for batch in slices(batches, "text"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "text", "copies")), batch.column("anchors"), batch.column("hot"))
            for key, text, copies, wanted, hot in rows:
                data = text.encode()
                anchors, firsts, lasts = segments(data, length)
                keep = np.isin(anchors, wanted.values.to_numpy())
                is_hot = np.isin(anchors[keep], hot.values.to_numpy())
                # anchors are the least of their neighbours: mixed again, they spread evenly over the targets
                places = _mixed(anchors[keep].view(np.uint64) ^ np.uint64(_BASE)).tolist()
                for place, first, last, h in zip(places, firsts[keep].tolist(), lasts[keep].tolist(), is_hot.tolist()):
                    body = data[first : last + length]
                    target = zlib.crc32(body) % targets if h else place * targets >> 64
                    entries.append((target, place.to_bytes(8, "big") + body, copies, h, (key, len(data), first)))
                    held += len(body) + 200
                if held > RUN_BYTES:
                    yield flush(entries)
                    entries, held = [], 0
        if entries:
            yield flush(entries)

    return run


def _anchor_lists(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lists = [segments(t.encode(), length)[0] for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "anchors": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))})

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the covered ranges (sorted by start) out of each text."""
    for batch in slices(batches, "text"):
        spans_out, kept_out = [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            data, spans = text.encode(), []
            for r in ranges:
                if spans and r["start"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], r["end"])
                else:
                    spans.append({"start": r["start"], "end": r["end"]})
            at, kept = 0, []
            for s in spans:
                kept.append(data[at : s["start"]])
                at = s["end"]
            spans_out.append(spans)
            kept_out.append(b"".join([*kept, data[at:]]))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "bytes": batch.column("bytes"), "spans": pa.array(spans_out, kind), "kept": pa.array(kept_out, pa.binary())})


def _texts_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """One row for each different text among ``keys`` (a stored table), with how many rows have it."""
    wanted = keys.select("key").distinct()
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return texts.join(wanted, "key", "left_semi").groupBy("key", "bytes").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def _occurring(rows: DataFrame, counts: DataFrame, hot: int) -> DataFrame:
    """``key, anchor, hot``: the rows of anchors that occur again.

    The hot ones, at most one in ``hot`` of all occurrences, are known by a
    broadcast as long as they number ``BROADCAST_KEYS`` or fewer. Their rows need
    no partner, so they go through the shuffled join spread by key and anchor.
    """
    often = counts.filter(F.col("n") > hot).select(F.col("anchor").alias("often"))
    if not 0 < often.count() <= BROADCAST_KEYS:
        return rows.join(counts, "anchor").select("key", "anchor", (F.col("n") > hot).alias("hot"))
    flagged = rows.join(F.broadcast(often), F.col("anchor") == F.col("often"), "left").withColumn("hot", F.col("often").isNotNull())
    at = F.when(F.col("hot"), F.xxhash64("key", "anchor")).otherwise(F.col("anchor"))
    few = counts.filter(F.col("n") <= hot).select(F.col("anchor").alias("few"))
    joined = flagged.withColumn("at", at).join(few, F.col("at") == F.col("few"), "left")
    return joined.filter("hot or few is not null").select("key", "anchor", "hot")


def covered_ranges(texts: DataFrame, length: int, hot: int) -> DataFrame:
    """``key, bytes, ranges``: what repeats in each text that has anything to lose; ``ranges`` sorted by start."""
    lists = texts.select("key", "text").mapInArrow(_anchor_lists(length), "key long, anchors array<long>")
    rows = lists.select("key", F.explode("anchors").alias("anchor"))
    counts = store(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    again = store(_occurring(rows, counts, hot).groupBy("key").agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot")))
    # a suffix is a window, its neighbours and what goes with it: about LENGTH and 200 bytes
    suffixes = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    targets = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-suffixes * (length + 200) // TARGET_BYTES))
    work = _texts_of(texts, again).join(again, "key").select("key", "text", "copies", "anchors", "hot")
    runs = work.mapInArrow(_sorted_runs(length, targets), "target int, run binary")
    schema = "window long, other long, weight long, key long, bytes long, start long, end long"
    found = store(runs.repartition(targets, "target").sortWithinPartitions("target").mapInArrow(_merge(length), schema))
    windows = found.filter("window is not null")
    twice = windows.groupBy("window", "other").agg(F.sum("weight").alias("n")).filter("n > 1").select("window", "other")
    late = windows.filter("key is not null").join(twice, ["window", "other"])
    place = ("key", "bytes", F.struct("start", "end").alias("range"))
    ranges = found.filter("window is null").select(*place).unionByName(late.select(*place))
    return ranges.groupBy("key", "bytes").agg(F.array_sort(F.collect_list("range")).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, per_text: dict[str, Column] | None = None) -> DataFrame:
    """``id_col, n_bytes, n_removed, spans`` of each row and the ``per_text`` columns.

    ``spans`` are the maximal removed byte ranges. ``per_text`` are expressions
    over ``kept`` (the remaining bytes), computed once for each different text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    ranges = store(covered_ranges(texts.drop("id"), length, hot))
    extra = per_text or {}
    cut = _texts_of(texts.drop("id"), ranges).join(ranges, ["key", "bytes"]).select("key", "bytes", "text", "ranges")
    done = cut.mapInArrow(_without, "key long, bytes long, spans array<struct<start:long,end:long>>, kept binary")
    done = store(done.select("key", "bytes", "spans", *(c.alias(f"cut_{n}") for n, c in extra.items())))
    whole = texts.withColumn("kept", F.col("text").cast("binary")).select("id", "key", "bytes", *(c.alias(f"whole_{n}") for n, c in extra.items()))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (
        whole.join(done, ["key", "bytes"], "left")
        .withColumn("spans", spans)
        .select(
            F.col("id").alias(id_col), F.col("bytes").alias("n_bytes"), removed.alias("n_removed"), "spans",
            *(F.coalesce(f"cut_{n}", f"whole_{n}").alias(n) for n in extra),
        )
    )
