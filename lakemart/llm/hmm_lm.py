"""A hidden Markov language model of the whole corpus, and the exact probability of each text under it.

Words are counted over all training texts; nothing is left out and the counts
stay a table. The ``SYMBOLS`` words of highest count (of two or more) are symbols
of their own; every other word stands for the class of its last three bytes,
one of ``CLASSES``. A hidden state emits a symbol or a class; a class emits one
of its words by absolute discounting, or, with the mass so saved, a word that no
training text holds (all such words of a class are one event). The tables of
symbols and classes have a fixed bound; the vocabulary grows with the corpus.
Its ``FREQUENT`` words go to the tasks with their counts, all others are joined.

Each round of Baum-Welch is one Spark job over all training texts: tasks add up
expected counts of their texts by exact forward and backward recursion, Spark
adds the tasks' counts by symbol, and the driver gets ``SYMBOLS + CLASSES`` rows.
The states start from the unigram distribution, tilted by seeded noise; a few
cheaper rounds, in which a text keeps one state, part them before they may move.

The score is the scaled forward recursion over the whole text, end included,
plus the logarithms of the words that are no symbols, within their classes.
Texts are turned into numbers once and stored; the words that are not frequent
are counted by text before they are joined with the vocabulary, where none of
them is a hot key.

Defined cases: a null or empty text is an end alone; a null id is held out of
nothing unless the caller says so; without training text every word is unknown
and all classes are equally likely; repeated rows are learnt from and scored
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hmm
from .common import slices, store, texts_of

SYMBOLS = 1 << 15
#: Words whose counts are broadcast, the symbols among them.
FREQUENT = 1 << 18
CLASSES = 1 << 10
#: Symbols and classes of a text are one value of bytes, which Spark copies whole, rather than an array.
SYMBOL = np.dtype("<u2")
STATES = 8
#: Rounds with one state to a text, and rounds of Baum-Welch.
STARTS, ROUNDS = 3, 2
#: Chance at first that a state follows itself.
STAY = 0.9
#: Taken off each count of a class's word, for the words that no training text holds.
DISCOUNT = 0.75
#: Symbols' worth of the unigram distribution added to each state.
STRENGTH = 200.0
SEED = 7
END = b""
#: Different words a task counts before it hands them on.
COUNTED = 300_000


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased, and the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def class_of(word: bytes) -> int:
    return crc32(word[-3:]) % CLASSES


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (bytes), ``c``: how often each word stands in all texts; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(counted.keys()), pa.binary()), pa.array(list(counted.values()), pa.int64())], ["word", "c"])

        for batch in slices(batches, text_col):
            for text in texts_of(batch, text_col):
                counted.update(words_of(text))
            if len(counted) > COUNTED:
                yield out()
                counted.clear()
        if counted:
            yield out()

    return docs.select(text_col).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """The vocabulary's table, its totals, and what is bounded of it: frequent words, symbols first, and the classes."""

    table: DataFrame
    tokens: int
    words: int
    least: int  # count of a frequent word at least
    frequent: tuple[bytes, ...]
    counts: np.ndarray  # of each frequent word
    symbols: int
    class_counts: np.ndarray  # of words that are no symbols
    class_words: np.ndarray

    @property
    def masses(self) -> np.ndarray:
        """How often each symbol, then each class, is emitted."""
        return np.concatenate([self.counts[: self.symbols], self.class_counts]).astype(float)


def _least(sizes: list[tuple[int, int]], most: int) -> int:
    """The smallest count, two at least, that no more than ``most`` words reach; ``sizes``: words of each count, highest first."""
    least, held = 1 << 62, 0
    for count, words in sizes:
        if count < 2 or held + words > most:
            break
        least, held = count, held + words
    return least


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """Count all words of ``docs`` and choose the symbols."""
    table = store(word_counts(docs, text_col))
    rounded = F.expr("c - c % cast(pow(2, greatest(0, floor(log2(c)) - 9)) as bigint)")  # ten leading bits: a bounded number of counts
    sizes = sorted(((r.q, r.n) for r in table.groupBy(rounded.alias("q")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, of_symbol = _least(sizes, FREQUENT), _least(sizes, SYMBOLS)
    frequent = sorted(((-r.c, bytes(r.word)) for r in table.filter(F.col("c") >= least).collect()))
    counts = np.array([-c for c, _ in frequent], np.int64)
    total = table.agg(F.sum("c"), F.count("*")).first()
    of_class = (F.crc32(F.substring("word", -3, 3)) % CLASSES).cast("int")
    classes = table.filter(F.col("c") < of_symbol).groupBy(of_class.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    mass, many = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in classes:
        mass[r.k], many[r.k] = r.c, r.n
    return Vocabulary(table, total[0] or 0, total[1], least, tuple(w for _, w in frequent), counts, int((counts >= of_symbol).sum()), mass, many)


class _Numbers(dict):
    """Frequent words by number; a word that is none counts as its class, after them."""

    def __missing__(self, word: bytes) -> int:
        return self.offset + class_of(word)


def encode(docs: DataFrame, known: Vocabulary, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, id, held_out, symbols, known, base, within, rare``, stored.

    ``known``, ``base`` (sum of log10(count + 1)) and ``within`` (of log10(count -
    discount), symbols aside) are of the text's frequent words; ``rare`` holds
    its other words, their class and number. ``symbols`` are numbers of type
    ``SYMBOL`` in one value.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((known.frequent, known.counts, known.symbols))
    rare = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("symbols", T.BinaryType()),
        T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("within", T.DoubleType()), T.StructField("rare", rare),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts, symbols = shared.value
        numbers = _Numbers(zip(frequent, range(len(frequent))))
        numbers.offset = len(frequent)
        number = numbers.__getitem__
        classes = np.array([class_of(w) for w in frequent[symbols:]], np.int64)
        symbol_of = np.concatenate([np.arange(symbols), symbols + classes, symbols + np.arange(CLASSES)]).astype(SYMBOL)
        base_of = np.concatenate([np.log10(counts + 1.0), np.zeros(CLASSES)])
        within_of = np.concatenate([np.zeros(symbols), np.log10(counts[symbols:] - DISCOUNT), np.zeros(CLASSES)])
        for batch in slices(batches, "text"):
            texts = [words_of(t) for t in texts_of(batch, "text")]
            sizes = np.array([len(t) for t in texts])
            flat = np.fromiter(map(number, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(texts)), sizes)
            own = flat < len(frequent)
            words, of_words, times, found = [], [], [], [0]
            for t, end in zip(texts, ends.tolist()):
                numbers_here = flat[end - len(t) : end]
                at = np.flatnonzero(numbers_here >= len(frequent))
                rare_here = list(map(t.__getitem__, at.tolist()))
                counted = Counter(rare_here)
                words += counted
                times += counted.values()
                of_words += dict(zip(rare_here, (numbers_here[at] - len(frequent)).tolist())).values()  # in the same order
                found.append(len(words))
            columns = [pa.array(words, pa.binary()), pa.array(of_words, pa.int32()), pa.array(times, pa.int64())]
            parts = pa.StructArray.from_arrays(columns, fields=list(out.field("rare").type.value_type))
            yield pa.record_batch([
                batch.column("id"), batch.column("held_out"),
                _texts_symbols(symbol_of[flat], ends),
                pa.array(np.bincount(owner[own], minlength=len(texts)), pa.int64()),
                *(pa.array(np.bincount(owner, of[flat], len(texts)), pa.float64()) for of in (base_of, within_of)),
                pa.ListArray.from_arrays(pa.array(found, pa.int32()), parts).cast(out.field("rare").type),
            ], schema=out)

    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    return store(rows.mapInArrow(run, schema).select(F.monotonically_increasing_id().alias("key"), "*"))


def _texts_symbols(flat: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """One value of bytes for each text, from symbols laid end to end and where texts end."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(SYMBOL.itemsize)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _sequences(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols laid end to end, and the lengths of the sequences."""
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1] // SYMBOL.itemsize
    return np.frombuffer(data, SYMBOL)[at[0] : at[-1]], np.diff(at)


def _together(batches: Iterator[pa.RecordBatch], rows: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about a block of symbols, so that numpy has long rows to work on."""
    held: list[pa.RecordBatch] = []
    symbols = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            symbols += len(_sequences(batch.column("symbols"))[0])
        if symbols > hmm.BLOCK or sum(b.num_rows for b in held) > rows:
            yield pa.concat_batches(held)
            held, symbols = [], 0
    if held:
        yield pa.concat_batches(held)


def first_chain(masses: np.ndarray, states: int = STATES) -> hmm.Chain:
    """States that stay, with the unigram distribution tilted by noise, so that they can part."""
    prior = (masses + 0.5) / (masses + 0.5).sum()
    emit = prior[:, None] * np.random.default_rng(SEED).gamma(2.0, 0.5, (len(masses), states)) + 1e-12
    move = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
    return hmm.Chain(np.full(states, 1 / states), move, emit / emit.sum(0))


def train(encoded: DataFrame, known: Vocabulary, rounds: int = ROUNDS, states: int = STATES, starts: int = STARTS) -> tuple[hmm.Chain, list[float]]:
    """Baum-Welch over all texts not held out; also the log-likelihood (base 10, by symbol) before each of its rounds."""
    spark = encoded.sparkSession
    masses = known.masses
    prior = (masses + 0.5) / (masses + 0.5).sum()
    chain = first_chain(masses, states)
    rows = len(masses)
    columns = [f"e{s}" for s in range(states)]
    schema = ", ".join(["row int", *(f"{c} double" for c in columns)])
    history = []
    for turn in range(starts + rounds):
        shared, whole_texts = spark.sparkContext.broadcast(chain.single()), turn < starts

        def run(batches: Iterator[pa.RecordBatch], shared=shared, whole_texts=whole_texts) -> Iterator[pa.RecordBatch]:
            counts = hmm.Counts(shared.value)
            seen = False
            for batch in _together(batches):
                sequences = _sequences(batch.column("symbols"))
                seen = True
                if whole_texts:
                    start, emit = hmm.mixture_counts(shared.value, *sequences)
                    counts.start += start
                    counts.emit += emit
                else:
                    counts.add(*sequences)
            if seen:  # rows: symbols and classes, then moves, first states, and the log-likelihood
                whole = np.concatenate([counts.emit, counts.move, counts.start[None], np.full((1, len(columns)), counts.likely)])
                at = np.flatnonzero(whole.any(1))
                yield pa.record_batch([pa.array(at, pa.int32()), *(pa.array(whole[at, s]) for s in range(len(columns)))], ["row", *columns])

        parts = encoded.filter(~F.col("held_out")).select("symbols").mapInArrow(run, schema)
        summed = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
        whole = np.zeros((rows + states + 2, states))
        whole[summed.column("row").to_numpy()] = np.stack([summed.column(c).to_numpy() for c in columns], 1)
        made = hmm.refit(chain, whole[-2], whole[rows : rows + states], whole[:rows], prior, STRENGTH)
        chain = hmm.Chain(made.start, chain.move, made.emit) if whole_texts else made
        if not whole_texts:
            history.append(float(whole[-1, 0] / np.log(10) / max(1, known.tokens)))
        shared.unpersist()
    return chain, history


def score(encoded: DataFrame, known: Vocabulary, chain: hmm.Chain, id_col: str = "doc_id") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = encoded.sparkSession
    mass = known.class_counts.astype(float)
    with np.errstate(divide="ignore"):
        of_class = -np.log10(np.where(mass > 0, mass, 1.0))
        unseen = np.where(mass > 0, np.log10(np.maximum(DISCOUNT * known.class_words, 1e-300)), 0.0)
    shared = spark.sparkContext.broadcast((chain, of_class))
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("id", encoded.schema["id"].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("within", T.DoubleType()), T.StructField("n_tokens", T.LongType()), T.StructField("likely", T.DoubleType()),
    ])
    out = to_arrow_schema(schema)
    many = known.symbols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, of_class = shared.value
        of_symbol = np.concatenate([np.zeros(many), of_class])
        for batch in _together(batches):
            flat, sizes = _sequences(batch.column("symbols"))
            likely = hmm.log_likelihoods(chain, flat, sizes) / np.log(10)
            likely += np.bincount(np.repeat(np.arange(len(sizes)), sizes), of_symbol[flat], len(sizes))
            kept = [batch.column(c) for c in ("key", "id", "held_out", "known", "base", "within")]
            yield pa.record_batch([*kept, pa.array(sizes, pa.int64()), pa.array(likely)], schema=out)

    scored = encoded.select("key", "id", "held_out", "known", "base", "within", "symbols").mapInArrow(run, schema)
    classes = spark.createDataFrame([(k, float(u)) for k, u in enumerate(unseen)], "k int, unseen double")
    rare = encoded.select("key", F.explode("rare").alias("r")).select("key", "r.*")
    rest = (
        rare.join(known.table.filter(F.col("c") < known.least), "word", "left")
        .join(F.broadcast(classes), "k")  # one row for each class
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("rare_known"),
            F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 1.0)).alias("rare_base"),
            F.sum(F.col("n") * F.when(F.col("c").isNotNull(), F.log10(F.col("c") - DISCOUNT)).otherwise(F.col("unseen"))).alias("rare_score"),
        )
    )
    none = F.lit(0.0)
    each = float(np.log10(known.tokens + known.words + 1))
    return scored.join(rest, "key", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", none) - F.col("n_tokens") * each).alias("base_score"),
        (F.col("likely") + F.col("within") + F.coalesce("rare_score", none)).alias("score"),
    )


def model_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not held out and score all rows."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    known = vocabulary(own.filter(~F.col("held_out")))
    encoded = encode(own, known, F.col("held_out"))
    chain, _ = train(encoded, known)
    return score(encoded, known, chain, id_col)
