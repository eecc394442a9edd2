"""Packing token pieces into sequences by a configuration linear program.

A configuration is a multiset of piece lengths that fits one sequence. The
program asks for the fewest sequences such that every length is covered as
often as it occurs. It is solved over the histogram of lengths (at most
``capacity`` numbers, however large the corpus) by multiplicative weights: each
round prices the lengths by their weights, a knapsack dynamic program finds the
configuration of the highest price, it is used as far as its scarcest length
allows, and weights of what it covers shrink. The fractional solution is
rounded down; best fit over the histogram of what remains packs the rest. How
much room a rounded configuration may leave for it to be used is tried from
none to all (``ROOM_LEFT``), and the plan of the fewest sequences holds. Using no
configuration at all, which is best fit alone, is one of the trials, so rounding
never does worse; ``Plan.tried`` tells what each trial came to.

The plan says, for the r-th piece of length l, which sequence and offset it
gets. Pieces are numbered within their length without bringing a length
together: each task counts its own pieces while it streams them, the numbered
pieces are stored, and small per-task counts are summed up to offsets.

Defined cases: a null text has only the end token; lengths that are null or
outside 1 to ``capacity`` get a null sequence and offset; repeated rows are
packed each; an empty table gives no rows; other columns are passed through by
``pack`` and ignored by ``tokenize_pieces``.
"""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices, store, texts_of

CAPACITY = 4096
END_ID = 1
#: Size classes of the linear program, its rounds, and how fast weights fall as a class is covered.
CLASSES = 256
ROUNDS = 2000
EPSILON = 0.2
#: Room that a rounded configuration may leave, by trial; all and none are tried besides.
ROOM_LEFT = (0, 4, 16, 64, 256)
#: Entries of each of the cache's two generations.
CACHE_PIECES = 200_000
RUN_WORDS = 1000
_TAIL = ".,;:!?*#$%&|)]}\""


# --- tokens ---------------------------------------------------------------------


class Slots(dict):
    """Ids of keys; one not known gets an empty slot that stands in the lists made of it until it is filled.

    A full cache becomes the elder of two generations, whose entries come back
    when they are asked for: the words of every text stay, those met once go.
    """

    def __init__(self, most: int):
        self.most = most
        self.elder: dict[bytes, bytes] = {}
        self.new: list[tuple[bytes, bytearray]] = []

    def __missing__(self, key: bytes) -> bytes | bytearray:
        found = self.elder.get(key)
        if found is None:
            found = bytearray()
            self.new.append((key, found))
        self[key] = found
        return found

    def taken(self) -> list[tuple[bytes, bytearray]]:
        """The slots to fill, once each."""
        new, self.new = self.new, []
        return new

    def fill(self, key: bytes, slot: bytearray, data: bytes) -> None:
        slot += data
        self[key] = data

    def turn(self) -> None:
        """Start a generation if this one is full."""
        if len(self) > self.most:
            self.elder = dict(self)
            self.clear()


class WordTokenizer:
    """Whole-text ids of a public tokenizer that drops white space, piece by piece from a cache.

    Normalization and splitting of that tokenizer never look across a space or
    a line end, so a text's ids are those of its pieces in order. Nor does a
    token span letters and punctuation: a word is encoded once for all the
    punctuation marks that may follow it.

    With ``added_tokens``, the library's default, a literal added token such as
    <|endoftext|> becomes its own id; texts that hold one go to the library whole.
    Without, it is ordinary text.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()] if added_tokens else []
        self.ends = np.zeros(self.library.get_vocab_size(), bool)  # tokens that end a word
        for token, i in self.library.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.pieces = Slots(CACHE_PIECES)

    def learn(self, letters: list[tuple[str, bytes, bytearray]], single: list[tuple[str, bytes, bytearray]]) -> None:
        """Fill in the ids of pieces; words of letters are encoded many at a time and cut at word ends."""
        fill = self.pieces.fill
        runs = [letters[i : i + RUN_WORDS] for i in range(0, len(letters), RUN_WORDS)]
        for run, made in zip(runs, self.library.encode_batch_fast([" ".join([w for w, _, _ in r]) for r in runs], add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(run):  # a letter was normalized to something else
                single += run
                continue
            data = ids.tobytes()
            begin = 0
            for (_, key, slot), end in zip(run, ends):
                fill(key, slot, data[begin:end])
                begin = end
        for (_, key, slot), made in zip(single, self.library.encode_batch_fast([w for w, _, _ in single], add_special_tokens=False)):
            fill(key, slot, np.array(made.ids, "<u4").tobytes())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each text."""
        whole = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        if not whole:
            return self._by_pieces(texts)
        self.library.encode_special_tokens = False
        own = {i: np.array(self.library.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes() for i in whole}
        self.library.encode_special_tokens = True
        rest = iter(self._by_pieces([t for i, t in enumerate(texts) if i not in whole]))
        return [own[i] if i in whole else next(rest) for i in range(len(texts))]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        self.pieces.turn()
        ids = self.pieces.__getitem__
        # the tokenizer ignores case: A-Z are made a-z at once, so that fewer pieces differ
        cut = [list(map(ids, t.encode().lower().replace(b"\n", b" ").split(b" "))) for t in texts]
        letters, single, joined = [], [], []
        while new := self.pieces.taken():
            for key, slot in new:
                piece = key.decode()
                if piece.isalpha():
                    letters.append((piece, key, slot))
                    continue
                word = piece.rstrip(_TAIL)
                if word.isalpha() and "İ" not in word:  # the one letter whose lower case ends in a mark
                    size = len(key) - len(piece) + len(word)  # punctuation has one byte
                    joined.append((key, slot, ids(key[:size]), ids(key[size:])))
                else:
                    single.append((piece, key, slot))
        self.learn(letters, single)
        for key, slot, word, tail in joined:
            self.pieces.fill(key, slot, bytes(word) + tail)
        return [b"".join(found) for found in cut]


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str, added_tokens: bool = False) -> WordTokenizer:
    return WordTokenizer(path, added_tokens)


def tokenize_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, piece, start, length, ids``: each text's ids and ``end_id``, cut at ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value, those
    of the library with its defaults: added tokens in a text become their ids.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, added_tokens=True)
        for batch in slices(batches, text_col, 1_500_000):
            row, piece, start, length, ids = [], [], [], [], []
            for i, data in enumerate(tokenizer.encode(texts_of(batch, text_col))):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    ids.append(part)
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column(id_col).take(pa.array(row, pa.int32())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    fields = [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()))]
    return docs.select(id_col, text_col).mapInArrow(run, T.StructType([docs.schema[id_col], *fields]))


# --- the program ----------------------------------------------------------------


def knapsack(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of sizes of the highest price that fits; ``prices[s]`` is that of size s."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(prices[: capacity + 1] > 0)
    worth = prices[sizes]
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    for room in range(1, capacity + 1):
        if k := fitting[room]:
            gain = best[room - sizes[:k]] + worth[:k]
            at = int(gain.argmax())
            best[room], last[room] = gain[at], sizes[at]
    chosen: Counter[int] = Counter()
    room = capacity
    while last[room]:
        chosen[int(last[room])] += 1
        room -= int(last[room])
    return dict(chosen)


def solve(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], float]]:
    """A fractional cover of ``demand[s]`` by configurations, by multiplicative weights."""
    needed = demand > 0
    if not needed.any():
        return []
    n = np.where(needed, demand, 1).astype(float)
    weights, covered = needed.astype(float), np.zeros(len(demand))
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        config = knapsack(weights / n, capacity)
        step = min(n[s] / k for s, k in config.items())
        key = tuple(sorted(config.items(), reverse=True))
        used[key] = used.get(key, 0.0) + step
        for s, k in config.items():
            covered[s] += k * step / n[s]
            weights[s] *= np.exp(-EPSILON * k * step / n[s])
        weights /= weights.max()
    scale = np.average(covered[needed], weights=(n * np.arange(len(n)))[needed])  # what is over or short is mended in rounding
    return [(dict(k), x / scale) for k, x in used.items()]


class Histogram:
    """Pieces left of each length, and which length is the longest that fits."""

    def __init__(self, demand: np.ndarray):
        self.left = demand.astype(np.int64).tolist()
        self.below = list(range(len(self.left)))  # a length at or below which the search may go on

    def longest(self, room: int) -> int:
        """The longest length of at most ``room`` with a piece left, or 0."""
        path = []
        while room and not self.left[room]:
            path.append(room)
            room = self.below[room] if self.below[room] != room else room - 1
        for p in path:
            self.below[p] = room
        return room

    def fill(self, config: dict[int, int], room: int) -> None:
        """Best fit: add the longest that fits, as often as it fits and lasts, until nothing does."""
        size = self.longest(room)
        while size:
            if k := min(room // size, self.left[size] - config.get(size, 0)):
                config[size] = config.get(size, 0) + k
                room -= k * size
            size = self.longest(min(room, size - 1))

    def take(self, config: dict[int, int], times: int) -> int:
        """Use ``config`` up to ``times`` times, as its pieces last."""
        times = min([times, *(self.left[s] // k for s, k in config.items())])
        for s, k in config.items():
            self.left[s] -= k * times
        return times


def best_fit(hist: Histogram) -> list[tuple[dict[int, int], int]]:
    """Best fit of all that is left: the longest piece first, then the longest that still fits, and so on.

    A filled sequence is repeated as often as its pieces last, so the number of
    steps depends on the number of different lengths, not on that of pieces.
    """
    capacity, out = len(hist.left) - 1, []
    while hist.longest(capacity):
        config: dict[int, int] = {}
        hist.fill(config, capacity)
        out.append((config, hist.take(config, 1 << 60)))
    return out


def _exact(hist: Histogram, config: dict[int, int], unit: int) -> dict[int, int]:
    """Lengths for the size classes of ``config``; the last piece is the longest that fits."""
    capacity, exact = len(hist.left) - 1, {}
    room, open_ = capacity, sum(config.values())
    for size in sorted(config, reverse=True):
        lengths = sorted(range(max(1, (size - 1) * unit + 1), min(size * unit, capacity) + 1), key=lambda n: -hist.left[n])
        for n in lengths:
            k = min(config[size], hist.left[n], open_ - 1)
            if k > 0:
                exact[n] = k
                room -= n * k
                open_ -= k
            break
    hist.fill(exact, room)
    return exact


def _rounded(demand: np.ndarray, capacity: int, unit: int, solution: list[tuple[dict[int, int], float]], most_room: int) -> list[tuple[dict[int, int], int]]:
    """``solution`` rounded down to whole sequences of real lengths that leave little room, and best fit for the rest."""
    hist, out = Histogram(demand), []
    for config, x in solution if most_room >= 0 else ():
        times = int(x + 1e-9)
        while times > 0:
            exact = _exact(hist, config, unit)
            if capacity - sum(n * k for n, k in exact.items()) > most_room:
                break  # best fit decides about these pieces at the end
            if not exact or not (done := hist.take(exact, times)):
                break
            out.append((exact, done))
            times -= done
    return out + best_fit(hist)


def plan_configurations(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Whole numbers of configurations that hold each length exactly as often as it occurs; and what was tried.

    The program sees lengths in classes of ``capacity / 256`` tokens, rounded
    up; when a configuration is rounded to whole sequences, classes get real
    lengths again and best fit uses the room that rounding up had left. The
    second result is the number of sequences for each limit of room left (-1:
    no configuration is used); the first limit with the fewest holds.
    """
    hist, out = Histogram(demand), []
    if full := hist.left[capacity]:
        out.append(({capacity: 1}, full))
        hist.left[capacity] = 0
    unit = -(-capacity // CLASSES)
    classes = np.zeros(capacity // unit + 1, np.int64)
    for n, count in enumerate(hist.left):
        if 0 < (size := -(-n // unit)) < len(classes):
            classes[size] += count
    solution = sorted(solve(classes, len(classes) - 1, rounds), key=lambda c: -c[1])
    rest = np.array(hist.left)
    plans = {room: _rounded(rest, capacity, unit, solution, room) for room in (*(r for r in ROOM_LEFT if r < capacity), capacity, -1)}
    tried = {room: full + sum(times for _, times in plan) for room, plan in plans.items()}
    return out + plans[min(tried, key=tried.__getitem__)], tried


@dataclass(frozen=True)
class Plan:
    """Where pieces go: for each length, ranges of ranks with their first sequence and offset."""

    keys: np.ndarray  # length << 40 | first rank of the range
    sequence: np.ndarray
    each: np.ndarray  # pieces of this length in one sequence
    offset: np.ndarray
    sequences: int
    #: sequences by the room that a rounded configuration might leave; -1: best fit alone
    tried: dict[int, int]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of the given lengths and ranks."""
        at = np.searchsorted(self.keys, length << 40 | rank, "right") - 1
        beyond = rank - (self.keys[at] & ((1 << 40) - 1))
        each = self.each[at]
        return self.sequence[at] + beyond // each, self.offset[at] + beyond % each * length


def make_plan(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> Plan:
    taken, rows, sequence = Counter(), [], 0
    configurations, tried = plan_configurations(demand, capacity, rounds)
    for config, times in configurations:
        offset = 0
        for size in sorted(config, reverse=True):
            rows.append((size << 40 | taken[size], sequence, config[size], offset))
            taken[size] += config[size] * times
            offset += size * config[size]
        sequence += times
    keys, seqs, each, offsets = (np.array(c, np.int64) for c in (zip(*sorted(rows)) if rows else ([],) * 4))
    return Plan(keys, seqs, each, offsets, sequence, tried)


# --- pieces ---------------------------------------------------------------------


def _numbered(pieces: DataFrame, length_col: str, task: str, local: str) -> DataFrame:
    """``pieces`` with the task and the running number within task and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            numbers = []
            for n in batch.column(length_col).to_pylist():
                numbers.append(seen[n])
                seen[n] += 1
            cols = {n: batch.column(n) for n in batch.schema.names}
            yield pa.RecordBatch.from_pydict(cols | {task: pa.array([own] * len(numbers), pa.int32()), local: pa.array(numbers, pa.int64())})

    return pieces.mapInArrow(run, T.StructType([*pieces.schema.fields, T.StructField(task, T.IntegerType()), T.StructField(local, T.LongType())]))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: gapless from 0 in each sequence."""
    names = pieces.columns
    if clash := {"sequence_id", "offset"} & {n.lower() for n in names}:
        raise ValueError(f"pieces already have {sorted(clash)}")
    task, local, first = (fresh(n, names) for n in ("task_", "local_", "first_"))
    stored = store(_numbered(pieces.withColumn(length_col, F.col(length_col).cast("long")), length_col, task, local))
    counts = stored.filter(F.col(length_col).between(1, capacity)).groupBy(length_col, task).agg(F.count(F.lit(1)).alias("n"))
    demand = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy(length_col).agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        demand[row[length_col]] = row["n"]
    plan = make_plan(demand, capacity, rounds)
    before = Window.partitionBy(length_col).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    starts = counts.select(length_col, task, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    ranked = stored.join(starts, [length_col, task], "left")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(first).is_valid().to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
            if known.any():
                size, start, number = (batch.column(c).fill_null(0).to_numpy()[known] for c in (length_col, first, local))
                sequence[known], offset[known] = plan.place(size, start + number)
            cols = {n: batch.column(n) for n in names}
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": pa.array(sequence, mask=~known), "offset": pa.array(offset, mask=~known)})

    fields = [f for f in stored.schema.fields if f.name in names]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*names, first, local).mapInArrow(place, schema)
