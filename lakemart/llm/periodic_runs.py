"""Periodic runs of words: maximal stretches that repeat a shorter one several times.

A run of smallest period ``q`` and length ``n`` is a stretch ``[s, e)`` of words in
which words ``q`` apart are equal, which no neighbour extends, with
``n >= max(LEAST, FOLDS * q)``. Then ``w[i] == w[i + q]`` holds on a stretch of at least
``(FOLDS - 1) * q`` places, so of the places ``0, 3q, 6q, ...`` at least one lies in it:
the harmonic grid. All grids of a text of ``n`` words together have ``n ln n / 3``
places; at each, the longest common extensions of ``i`` and ``i + q`` to both sides
give the run.

The extensions come from a difference cover: every pair of places is, at most
six words on, at two places whose remainders modulo 7 are in ``{0, 1, 3}``.
Only the suffixes at such places are sorted, by doubling windows of seven
words. A query compares words until both places are in the cover, then takes
the least common prefix between the two ranks, by a sparse table whose levels
are made one after another, each answering the queries of its width. The same
on the reversed words extends to the left.

A task works on a slice of many texts laid end to end, longest first, each
closed by a word of its own, so that no extension leaves its text. A first
look at seven words to both sides leaves few grid places; only texts that
have one are sorted. Memory follows the slice (4 MB of text, or one text).

Defined cases: a null text has no words; a null id plants nothing in
``planted``; ties of length go to the smallest start; of several periods of one
stretch the smallest counts; repeated rows give a row each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, texts_of

LEAST, FOLDS = 6, 4
#: Every difference modulo 7 is one between two members.
MODULUS, COVER = 7, (0, 1, 3)
#: Grid places looked at together.
BLOCK = 1 << 21

_IN_COVER = np.zeros(MODULUS, bool)
_IN_COVER[list(COVER)] = True
#: Words after which places of remainders a and b are both in the cover.
_SHIFT = np.array([[next(d for d in range(MODULUS) if _IN_COVER[(a + d) % MODULUS] and _IN_COVER[(b + d) % MODULUS]) for b in range(MODULUS)] for a in range(MODULUS)])


def _ranks(*keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of rows of ``keys`` (first key first), and how many there are."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, int(new.sum()) + 1 if len(order) else 0


class Extensions:
    """Longest common extensions to the right, over ``words`` whose last word occurs nowhere else."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        n = len(words)
        self.padded = np.concatenate([words, np.full(2 * MODULUS, -1, words.dtype)])  # past the end: smaller than any word
        places = np.arange(n)
        self.sample = places[_IN_COVER[places % MODULUS]]
        self.number = np.full(n + MODULUS, -1, np.int64)  # of a sampled place among them
        self.number[self.sample] = np.arange(len(self.sample))
        width = np.int64(int(words.max(initial=0)) + 2)
        fit = max(1, min(MODULUS, int(62 // max(1, np.log2(float(width))))))
        keys = []
        for start in range(0, MODULUS, fit):
            key = np.zeros(len(self.sample), np.int64)
            for d in range(start, min(start + fit, MODULUS)):
                key = key * width + (self.padded[self.sample + d] + 1)
            keys.append(key)
        rank, distinct = _ranks(*keys)
        levels = [rank]  # of windows of 7, 14, 28, ... words
        span = MODULUS
        while distinct < len(self.sample):
            after = self._at(levels[-1], self.sample + span)
            rank, distinct = _ranks(levels[-1], after)
            levels.append(rank)
            span *= 2
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        self.common = self._neighbours(order, levels)

    def _at(self, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks at sampled places; -1 past the end."""
        inside = places < len(self.words)
        out = np.full(len(places), -1, np.int64)
        out[inside] = rank[self.number[places[inside]]]
        return out

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix with the next in order: whole windows, widest first, then words."""
        a, b = self.sample[order[:-1]].copy(), self.sample[order[1:]].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            rank = levels[k]
            left, right = self._at(rank, a), self._at(rank, b)
            same = (left == right) & (left >= 0)
            step = same * (MODULUS << k)
            a, b, length = a + step, b + step, length + step
        return length + self._words_on(a, b, np.full(len(a), MODULUS))

    def _words_on(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from places ``a`` and ``b`` on, at most ``most``; the last word stops any of them."""
        length = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for d in range(int(most.max(initial=0))):
            live = live[(most[live] > d) & (self.padded[a[live] + d] == self.padded[b[live] + d])]
            if not len(live):
                break
            length[live] += 1
        return length

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of each pair of different places."""
        shift = _SHIFT[a % MODULUS, b % MODULUS]
        length = self._words_on(a, b, shift)
        on = np.flatnonzero(length == shift)
        x, y = a[on] + shift[on], b[on] + shift[on]
        inside = (x < len(self.words)) & (y < len(self.words))
        on, x, y = on[inside], x[inside], y[inside]
        rx, ry = self.rank[self.number[x]], self.rank[self.number[y]]
        length[on] += self._least(np.minimum(rx, ry), np.maximum(rx, ry))
        return length

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of ``common[low:high]`` for each pair, level by level of the sparse table."""
        out = np.zeros(len(low), np.int64)
        level = np.frexp((high - low).astype(float))[1] - 1
        table = self.common
        for k in range(int(level.max(initial=-1)) + 1):
            if k:
                half = 1 << (k - 1)
                table = np.minimum(table[:-half], table[half:])
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        return out


def _grid(sizes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of all grids, in blocks; texts stand longest first, ``ends`` after their closing words."""
    longest = int(sizes[0]) if len(sizes) else 0
    periods = np.arange(1, longest // FOLDS + 1)
    if not len(periods):
        return
    # texts with FOLDS * p words or more are the first ones; a grid covers them all
    texts = np.searchsorted(-sizes, -FOLDS * periods, side="right")
    step = (FOLDS - 1) * periods
    counts = -(-(ends[texts - 1] - periods) // step)
    done = np.cumsum(counts)
    at = 0
    while at < len(periods):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + BLOCK, side="right")))
        many = counts[at:stop]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        yield nth * np.repeat(step[at:stop], many), np.repeat(periods[at:stop], many)
        at = stop


def _look(words: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which grid places may lie in a run: equal there, and for up to seven words to both sides together."""
    live = np.flatnonzero(words[place] == words[place + period])
    need = np.minimum(MODULUS, (FOLDS - 1) * period[live])
    n = len(words)
    seen = np.ones(len(live), np.int64)
    for direction in (1, -1):
        going = np.arange(len(live))
        for d in range(1, MODULUS):
            a = place[live[going]] + direction * d
            b = a + period[live[going]]
            inside = (a >= 0) & (b < n)
            going, a, b = going[inside], a[inside], b[inside]
            going = going[words[a] == words[b]]
            if not len(going):
                break
            seen[going] += 1
    return live[seen >= need]


def _runs(words: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs over texts laid end to end, longest first."""
    found = []
    forward, backward = Extensions(words), Extensions(np.concatenate([words[-2::-1], words[-1:]]))
    n = len(words)
    for place, period in _grid(sizes, ends):
        at = _look(words, place, period)
        i, p = place[at], period[at]
        right = forward.of(i, i + p)
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        left[inner] = backward.of(n - 1 - i[inner], n - 1 - i[inner] - p[inner])
        length = left + right + p
        ok = np.flatnonzero(length >= np.maximum(LEAST, FOLDS * p))
        if len(ok):
            found.append(np.unique(np.stack([i[ok] - left[ok], length[ok], p[ok]], 1), axis=0))
    if not found:
        return np.zeros((0, 3), np.int64)
    every = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    return every[first]


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as word numbers, its runs as rows (start, length, period), by start, then period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    order = [i for i in np.argsort(-sizes, kind="stable") if sizes[i] >= LEAST]
    if not order:
        return out

    def laid(chosen: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        top = max(int(texts[i].max()) for i in chosen) + 1
        parts = chain.from_iterable((texts[i], [top + k]) for k, i in enumerate(chosen))
        return np.concatenate(list(parts)).astype(np.int64), sizes[chosen], np.cumsum(sizes[chosen] + 1)

    words, own, ends = laid(order)
    hit = np.zeros(len(order), bool)
    for place, period in _grid(own, ends):
        hit[np.searchsorted(ends, place[_look(words, place, period)], side="right")] = True
    chosen = [i for i, h in zip(order, hit) if h]
    if not chosen:
        return out
    words, own, ends = laid(chosen)
    runs = _runs(words, own, ends)
    text = np.searchsorted(ends, runs[:, 0], side="right")
    for k, i in enumerate(chosen):
        mine = runs[text == k] if len(chosen) < 50 else runs[np.searchsorted(text, k) : np.searchsorted(text, k, side="right")]
        mine = mine - [ends[k] - own[k] - 1, 0, 0]
        out[i] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """``words``; for a tenth of the ids, their end replaced by repetitions of a stretch that starts in them."""
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``id_col, n_words, runs, kept``: the runs by start, then period, and the text with each run's first period only.

    ``kept`` is the remaining words joined by one space. ``change`` may replace a
    text's words, given its id, before they are read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([docs.schema[id_col], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("kept", T.StringType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            ids = batch.column(id_col).to_pylist()
            texts = [t.encode().split() for t in texts_of(batch, text_col)]
            if change:
                texts = [change(i, w) for i, w in zip(ids, texts)]
            numbers: dict[bytes, int] = {}
            coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in t), np.int64, len(t)) for t in texts]
            found = find_runs(coded)
            rows = []
            for words, runs in zip(texts, found):
                if len(runs):
                    stay = collapsed(len(words), runs)
                    rows.append(b" ".join([w for w, s in zip(words, stay.tolist()) if s]).decode())
                else:
                    rows.append(b" ".join(words).decode())
            flat = np.concatenate(found)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(out.field("runs").type.value_type))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32()), structs)
            yield pa.record_batch([batch.column(id_col), pa.array([len(t) for t in texts], pa.int64()), lists.cast(out.field("runs").type), pa.array(rows, out.field("kept").type)], schema=out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: number of runs, the longest, and digests of all runs and of the remaining text."""
    # the longest; of those the first, then the smallest period
    key = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))

    def of(c: Column, name: str) -> Column:
        return c.cast("long").alias(name)

    return found.withColumn("longest", key).select(
        id_col,
        of(F.size("runs"), "n_runs"),
        of(-F.col("longest.s"), "start"),
        of(F.col("longest.length"), "length"),
        of(-F.col("longest.p"), "period"),
        of(F.floor(1000 * F.col("longest.length") / -F.col("longest.p")), "exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )

