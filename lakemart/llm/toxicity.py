"""Toxicity by a linear-chain conditional random field over tokens.

Labels say which documents are toxic, not which words. Words, and beginnings
of words, whose document frequency among toxic documents cannot be chance
(binomial tail, corrected for the number of them) mark the offending tokens of
toxic documents; the field learns from those token labels. Scoring runs forward-backward over every
sentence of every text: the marginals give offending spans, and their largest
value and their sum, calibrated by logistic regression, give the document's
score.

Document frequencies and calibration read all labelled texts, whole, as Spark
jobs; a caller can exclude rows (the query leaves out those held out). The field
itself learns from a sample of their sequences (of at most ``MOST_TOKENS``
tokens, from anywhere in a text), drawn in the pass that counts them: sequences
are divided by the label of their text and the rarest mark they hold, each such
stratum gives those whose hash is below a limit: about ``MARKED_SEQUENCES`` shared by all strata with a mark (all
of a stratum of up to ``LEAST_SEQUENCES``, at least as many to be expected from
a larger one, which then goes unseen with a chance of 3e-4 at most) and about
``PLAIN_SEQUENCES`` from each without, and a sequence counts as many times as it
stands for. Only the text is ever an input of a score.

Defined cases: null and empty texts get the score of a text without evidence;
without labels of both classes every score is the share of toxic labels;
repeated rows each give a row; an empty table gives no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_KEYS, Numbers, slices, store, texts_of
from .crf import BEGINNINGS, Chain, Features, core_of, ends_sentence, sequences, shape_of, train

MARKED_SEQUENCES = 16_000
LEAST_SEQUENCES = 8
PLAIN_SEQUENCES = 6_000
#: Tokens of each of a cache's two generations, and marks a task counts before it hands them on.
CACHE_TOKENS = 150_000
MARKS_HELD = 300_000
#: Cells of evidence to a unit, in which labelled texts are counted for calibration.
CELLS = 64
_WORD = re.compile(r"\S+")


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    chain: Chain = field(default_factory=Chain)
    #: intercept, weight of the largest marginal's log-odds, weight of the log of their sum
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def score(self, most: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-(a + evidence(most, total) @ np.array([b, c]))))


def evidence(most: np.ndarray, total: np.ndarray) -> np.ndarray:
    m = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(m / (1 - m)), np.log1p(total)], 1)


class Emissions:
    """Scores of tokens by the field's weights, looked up without making the names of features."""

    def __init__(self, model: Model):
        self.bias = model.bias
        self.by_kind: dict[str, dict[str, float]] = {k: {} for k in "wbelk"}
        for name, weight in model.weights.items():
            self.by_kind[name[0]][name[2:]] = weight

    def of(self, token: str) -> float:
        core, shape = core_of(token), shape_of(token)
        words, beginnings, ends, lengths, shapes = self.by_kind.values()
        n = len(core)
        out = self.bias + words.get(core, 0.0) + ends.get(core[-3:], 0.0) + lengths.get(str(min(n, 12)), 0.0) + shapes.get(shape, 0.0)
        for k in BEGINNINGS:
            if k >= n:
                break
            out += beginnings.get(core[:k], 0.0)
        return out


class Tagger:
    """Marginals of tokens, one text after another; remembers tokens that came up lately."""

    def __init__(self, model: Model):
        self.chain = model.chain
        self.emission = Emissions(model).of
        self.tokens = Numbers(CACHE_TOKENS)

    def tag(self, texts: list[str]) -> tuple[list[list[str]], list[np.ndarray]]:
        """Tokens and offending probabilities of each text."""
        self.tokens.turn()
        cut = [t.split() for t in texts]
        sizes = np.array([len(tokens) for tokens in cut], np.int64)
        ids = np.fromiter(map(self.tokens.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        values = self.tokens.values
        for token in self.tokens.taken():
            values[self.tokens[token]] = complex(self.emission(token), ends_sentence(token))
        own = np.array(values, complex)[ids] if len(ids) else np.zeros(0, complex)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        starts, lengths = sequences(own.imag > 0, bounds[:-1][sizes > 0])
        p = self.chain.marginals(own.real, starts, lengths)
        return cut, [p[a:b] for a, b in zip(bounds, bounds[1:])]


def marks_of(token: str) -> list[str]:
    """The features of a token that can mark it: the word, and beginnings of four letters or more."""
    core = core_of(token)
    return ["w=" + core, *("b=" + core[:n] for n in BEGINNINGS if 4 <= n < len(core))]


def beyond_chance(everywhere: np.ndarray, bad: np.ndarray, rate: float, tried: int, chance: float = 1.0) -> np.ndarray:
    """Which marks are in more toxic texts than chance allows.

    A mark is in ``everywhere`` texts, ``bad`` of them toxic, where ``rate`` of
    all texts are. About ``chance`` of all marks ``tried`` would be one by luck.
    """
    share = bad / np.maximum(everywhere, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        # P(at least this share of that many texts) by the Chernoff bound
        divergence = share * np.log(share / rate) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0)
    likely = (bad >= 3) & (share >= 3 * rate) & (share >= 0.4)
    return likely & (-everywhere * divergence < np.log(chance / max(1, tried)))


class MarkCounts:
    """Texts, and toxic texts, that hold each mark; the mark "" is in every text.

    Marks are numbered, and a token stands for the numbers of its marks, so a
    text's marks are one union of sets of numbers.
    """

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.names: dict[str, int] = {"": 0}
        self.known: dict[str, tuple[int, ...]] = {}
        self.ids, self.bad_ids = array("q"), array("q")
        self.counts = np.zeros((2, 1), np.int64)

    def add(self, text: str, toxic: bool) -> None:
        tokens, known, names = set(text.split()), self.known, self.names
        for t in tokens.difference(known):
            known[t] = tuple(names.setdefault(m, len(names)) for m in marks_of(t))
        own = array("q", {0}.union(*map(known.__getitem__, tokens)))
        self.ids.extend(own)
        if toxic:
            self.bad_ids.extend(own)
        if len(self.ids) > 1_000_000:
            self.settle()

    def settle(self) -> np.ndarray:
        """Texts and toxic texts by number of the mark."""
        counts = np.stack([np.bincount(np.frombuffer(ids, np.int64), minlength=len(self.names)) if len(ids) else np.zeros(len(self.names), np.int64) for ids in (self.ids, self.bad_ids)])
        counts[:, : self.counts.shape[1]] += self.counts
        self.counts, self.ids, self.bad_ids = counts, array("q"), array("q")
        return counts

    @property
    def texts(self) -> dict[str, int]:
        return dict(zip(self.names, self.settle()[0].tolist()))

    @property
    def toxic(self) -> dict[str, int]:
        return dict(zip(self.names, self.settle()[1].tolist()))


class Strata:
    """Sequences of labelled texts, and the stratum of each: the label of its text and the rarest mark in it."""

    def __init__(self, marks: dict[str, int]):
        self.marks = marks  # texts that hold each
        self.known: dict[str, tuple[int, str] | None] = {}

    def split(self, text: str, toxic: bool) -> Iterator[tuple[str, list[str]]]:
        if len(self.known) > CACHE_TOKENS:
            self.known = {}
        tokens, known, marks = text.split(), self.known, self.marks
        if not tokens:
            return
        for t in set(tokens).difference(known):
            known[t] = min(((marks[m], m) for m in marks_of(t) if m in marks), default=None)
        ends = np.array([ends_sentence(t) for t in tokens], bool)
        for a, n in zip(*(x.tolist() for x in sequences(ends, np.array([0])))):
            own = tokens[a : a + n]
            rarest = min((k for k in map(known.__getitem__, own) if k), default=(0, ""))
            yield ("+" if toxic else "-") + rarest[1], own


def shares(sizes: dict[str, int]) -> dict[str, float]:
    """The part of each stratum's sequences that the field learns from."""
    each = max(LEAST_SEQUENCES, MARKED_SEQUENCES // max(1, sum(len(s) > 1 for s in sizes)))
    return {s: (each if len(s) > 1 else PLAIN_SEQUENCES) / n for s, n in sizes.items()}


def lot(key: str, number: int) -> float:
    """A number from 0 to 1 for a sequence of a text; those below a stratum's share are chosen."""
    return xxhash.xxh3_64_intdigest(f"{key}:{number}") / 2.0**64


def fit_field(sample: Iterable[tuple[str, list[str]]], marks: dict[str, int], sizes: dict[str, int]) -> Model:
    """The field (not calibrated) from sequences with their strata, of which there are ``sizes``."""
    ids: dict[str, int] = {}
    strata, docs = [], []
    for stratum, tokens in sample:
        strata.append(stratum)
        docs.append(np.array([ids.setdefault(t, len(ids)) for t in tokens], np.int32))
    marked = np.array([any(m in marks for m in marks_of(t)) for t in ids], bool)
    features, often = Features(ids), Counter(strata)
    numbers, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    toxic = np.array([s[0] == "+" for s in strata], bool)
    states = (marked[numbers] & np.repeat(toxic, lengths)).astype(np.int64)
    stand_for = np.array([sizes[s] / often[s] for s in strata])
    del ids, docs
    return Model(*train(features, numbers, states, np.cumsum(lengths) - lengths, lengths, weights=stand_for))


def calibrate(x: np.ndarray, toxic: np.ndarray, texts: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton's method; a row stands for ``texts`` texts, ``toxic`` of them toxic."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (toxic - texts * p) - ridge * w
        h = (a * (texts * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)  # type: ignore[return-value]


def flat_model(texts: int, toxic: int) -> Model:
    share = (toxic + 0.5) / (texts + 1)
    return Model(calibration=(float(np.log(share / (1 - share))), 0.0, 0.0))


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """The model from labelled texts at hand, as ``learn`` has it from a table."""
    toxic = np.asarray(toxic, bool)
    flat = flat_model(len(texts), int(toxic.sum()))
    if not toxic.any() or toxic.all():
        return flat
    counts = MarkCounts()
    for t, y in zip(texts, toxic):
        counts.add(t, y)
    everywhere, bad = counts.settle()
    found = beyond_chance(everywhere, bad, toxic.mean(), len(everywhere) - 1)
    marks = {m: n for m, n, f in zip(counts.names, everywhere.tolist(), found) if f and m}
    if not marks:
        return flat
    strata = Strata(marks)
    sizes = Counter(s for t, y in zip(texts, toxic) for s, _ in strata.split(t, y))
    part = shares(sizes)
    model = fit_field([(s, own) for i, (t, y) in enumerate(zip(texts, toxic)) for k, (s, own) in enumerate(strata.split(t, y)) if lot(str(i), k) < part[s]], marks, sizes)
    most, total = summaries(Tagger(model).tag(texts)[1])
    model.calibration = calibrate(evidence(most, total), toxic.astype(float), np.ones(len(texts)))
    return model


def summaries(marginals: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and sum of marginals of each text; a text without tokens has none."""
    return np.array([p.max() if len(p) else 0.0 for p in marginals]), np.array([p.sum() for p in marginals])


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``key, said, toxic`` of all rows with a label; contradicting labels count by their mean."""
    rows = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("said")).join(truth_of(labels, id_col, label_col), id_col)
    return rows.select(F.col(id_col).cast("string").alias("key"), "said", "toxic")


def truth_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id_col, toxic``: the label of each id that has one."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    truth = store(known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).alias("toxic")))
    return F.broadcast(truth) if truth.count() <= BROADCAST_KEYS else truth


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, bool]]:
    for batch in slices(batches, "said"):
        yield from zip(*(batch.column(c).to_pylist() for c in ("key", "said", "toxic")))


def mark_counts(texts: DataFrame) -> DataFrame:
    """``mark, n, bad``: labelled texts, and toxic ones, that hold each mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = MarkCounts()

        def made() -> pa.RecordBatch:
            n, bad = counts.settle()
            return pa.RecordBatch.from_pydict({"mark": pa.array(list(counts.names), pa.string()), "n": pa.array(n), "bad": pa.array(bad)})

        for _, said, toxic in _rows(batches):
            counts.add(said, toxic)
            if len(counts.names) > MARKS_HELD:
                yield made()
                counts.forget()
        yield made()

    return texts.mapInArrow(run, "mark string, n long, bad long").groupBy("mark").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def learnt_marks(counts: DataFrame, rate: float, tried: int) -> dict[str, int]:
    """Marks that toxic texts hold more often than chance allows, with the number of texts that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(beyond_chance(batch.column("n").to_numpy(), batch.column("bad").to_numpy(), rate, tried)))

    return {r.mark: r.n for r in counts.filter("bad >= 3 and mark <> ''").mapInArrow(run, counts.schema).collect()}


def sampled_sequences(texts: DataFrame, marks: dict[str, int], n: int, bad: int) -> tuple[list[tuple[str, list[str]]], dict[str, int]]:
    """The strata and tokens of the sequences that the field learns from, and the number of sequences in each stratum.

    One pass counts the strata and stores candidates: of marked sequences those
    with the lowest lots of each stratum in a task, of the others those that
    would be chosen if each of the ``n`` texts (``bad`` of them toxic) held one
    sequence; they hold more, so none that the share admits is missing there.
    """
    most = 2 * max(LEAST_SEQUENCES, MARKED_SEQUENCES // max(1, len(marks)))
    plain = {"+": PLAIN_SEQUENCES / max(1, bad), "-": PLAIN_SEQUENCES / max(1, n - bad)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strata, sizes, lowest = Strata(marks), Counter(), defaultdict(list)

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_pydict({name: pa.array(c, kind) for (name, kind), c in zip((("stratum", pa.string()), ("n", pa.int64()), ("lot", pa.float64()), ("tokens", pa.string())), columns)})

        for key, said, toxic in _rows(batches):
            found = []
            for k, (s, own) in enumerate(strata.split(said, toxic)):
                sizes[s] += 1
                drawn = lot(key, k)
                if len(s) == 1:
                    if drawn < plain[s]:
                        found.append((s, None, drawn, " ".join(own)))
                elif len(lowest[s]) < most:
                    heapq.heappush(lowest[s], (-drawn, " ".join(own)))
                elif -drawn > lowest[s][0][0]:
                    heapq.heapreplace(lowest[s], (-drawn, " ".join(own)))
            if found:
                yield made(found)
        if sizes:
            yield made([(s, c, None, None) for s, c in sizes.items()])
        for s, rows in lowest.items():
            yield made([(s, None, -drawn, tokens) for drawn, tokens in rows])

    stored = store(texts.mapInArrow(run, "stratum string, n long, lot double, tokens string"))
    sizes = {r.stratum: r.n for r in stored.filter("n IS NOT NULL").groupBy("stratum").agg(F.sum("n").alias("n")).collect()}
    part = shares(sizes)

    def admitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limits = np.array([part[s] for s in batch.column("stratum").to_pylist()])
            yield batch.filter(pa.array(batch.column("lot").to_numpy() < limits))

    rows = stored.filter("tokens IS NOT NULL").select("stratum", "lot", "tokens").mapInArrow(admitted, "stratum string, lot double, tokens string").collect()
    return [(s, tokens.split()) for s, tokens in sorted((r.stratum, r.tokens) for r in rows)], sizes


def evidence_cells(tagged: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Evidence, and the number of toxic and of all labelled texts that have it: a grid of about a million cells at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.rint(evidence(batch.column("most").to_numpy(), batch.column("total").to_numpy()) * CELLS).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(cells[:, 0]), "b": pa.array(cells[:, 1]), "bad": batch.column("toxic").cast(pa.int64())})

    rows = tagged.select("most", "total", "toxic").mapInArrow(run, "a long, b long, bad long").groupBy("a", "b").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
    x = np.array(sorted((r.a, r.b, r.bad, r.n) for r in rows), float)
    return x[:, :2] / CELLS, x[:, 2], x[:, 3]


def learn_field(texts: DataFrame) -> Model:
    """The field from all ``labelled_texts``, not calibrated; the share of toxic labels where there is nothing to learn."""
    counts = store(mark_counts(texts))
    n, bad = counts.filter("mark = ''").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    flat = flat_model(n, bad)
    if bad in (0, n):
        return flat
    marks = learnt_marks(counts, bad / n, counts.count() - 1)
    if not marks:
        return flat
    sample, sizes = sampled_sequences(texts, marks, n, bad)
    return fit_field(sample, marks, sizes)


def _usable(labels: DataFrame, usable: Column | None) -> DataFrame:
    return labels if usable is None else labels.filter(usable)


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model from all labelled rows that ``usable`` (over the id) admits."""
    texts = labelled_texts(docs, _usable(labels, usable), id_col, text_col, label_col)
    model = learn_field(texts)
    if model.weights:
        model.calibration = calibrate(*evidence_cells(tag_texts(texts, model, "said", ("toxic",))))
    return model


def learn_and_score(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id_col, score, spans`` of each row, as ``learn`` and ``score_texts`` give them, tagging each text once."""
    own = docs.select(id_col, text_col)
    known = _usable(labels, usable)
    model = learn_field(labelled_texts(own, known, id_col, text_col, label_col))
    if not model.weights:
        return score_texts(own, model, id_col, text_col)
    tagged = store(tag_texts(own, model, text_col, (id_col,)))
    model.calibration = calibrate(*evidence_cells(tagged.join(truth_of(known, id_col, label_col), id_col)))
    return scored(tagged, model, id_col)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def spans_of(text: str, offending: np.ndarray) -> list[dict[str, int]]:
    """Offsets of runs of offending tokens."""
    out: list[dict[str, int]] = []
    last = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if offending[i]:
            if i == last + 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    return out


def tag_texts(docs: DataFrame, model: Model, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns, ``most`` and ``total`` (largest marginal and their sum) and ``spans`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches, text_col):
            texts = texts_of(batch, text_col)
            _, marginals = tagger.tag(texts)
            most, total = summaries(marginals)
            spans = [spans_of(t, p > 0.5) if m > 0.5 else [] for t, p, m in zip(texts, marginals, most)]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"most": pa.array(most), "total": pa.array(total), "spans": pa.array(spans, kind)})

    numbers = [T.StructField(n, T.DoubleType()) for n in ("most", "total")]
    return docs.select(*keep, text_col).mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *numbers, T.StructField("spans", SPANS)]))


def scored(tagged: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """``id_col, score, spans`` of rows of ``tag_texts``."""
    a, b, c = model.calibration
    m = F.greatest(F.least(F.col("most"), F.lit(1 - 1e-6)), F.lit(1e-6))
    odds = F.lit(a) + F.lit(b) * F.log(m / (1 - m)) + F.lit(c) * F.log1p("total")
    return tagged.select(id_col, (1 / (1 + F.exp(-odds))).alias("score"), "spans")


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, spans`` of each row."""
    return scored(tag_texts(docs, model, text_col, (id_col,)), model, id_col)
