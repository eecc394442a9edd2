"""Quality classifier by co-training on two views.

The content view describes words and characters; the metadata view describes
the page (language, source, size, layout). Each view has its own logistic
regression over steps of its features. Over a few rounds each classifier
labels the unlabelled documents it is surest of, in the proportion of the
labels, and hands them to the other. At the end both are calibrated on labelled
rows that neither has trained on, and the mean of their log-odds, weighted by
how well each view does there, scores every document.

All rows take part: the features of every document are made in one pass over
the texts and stored, and each step of the training is one Spark job over them
that adds up numbers of fixed size: a Newton step of both views (gradient and
curvature), the confidence of the rows not yet taught (a histogram by class,
from which the cut for the confident share is taken; rows of the cut's bin go
together), the calibration (a histogram of the held rows). No list of taught
rows is kept: a task derives what each row was taught from the classifiers and
cuts of the rounds before.

Defined cases: null texts count as empty and missing metadata as its own
category; a missing metadata column counts as all null; without labels of both
classes everything is kept with the share of good labels as score; a label of a
row with a null id counts for no row; contradicting labels count by their mean;
repeated rows are learnt from and scored each; an empty table gives no rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_KEYS, slices, store
from .textstats import EMPTY, Counter, ratio_arrays, ratios, text_counts

ROUNDS = 5
#: Newton steps of the first fit, and of each later one, which starts from the fit before.
FIRST_STEPS, STEPS_MORE = 7, 2
#: Share of the unlabelled rows taught in a round, and the least confidence.
SHARE, SURE = 0.05, 0.9
#: Bins of log-odds to a unit, and the largest log-odds told apart.
BINS, MOST = 64, 30
STEPS = 12
SLOTS = 32
CONTENT = ("chars_per_word", "symbols_per_word", "bars_per_word", "bangs_per_word", "digits_per_word", "upper_share", "repeat_share", "distinct_share")
LAYOUT = ("words", "lines", "dup_line_share", "ended_line_share", "words_per_line", "chars")
NUMBERS = tuple(dict.fromkeys(CONTENT + LAYOUT))
CATEGORIES = ("lang", "source")

Rows = dict[str, np.ndarray]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(a: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12, often: np.ndarray | float = 1.0) -> np.ndarray:
    """Weights by Newton's method with a ridge penalty; the first column is the intercept, a row stands ``often`` times."""
    w, penalty = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(a @ w)
        h = (a * (often * p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, a.T @ (often * (y - p)) - penalty * w)
        w = w + step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class View:
    """One classifier: steps at quantiles of its numbers, slots for its categories."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...] = ()
    edges: dict[str, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray | None = None
    #: intercept and slope that turn raw log-odds into calibrated ones
    calibration: tuple[float, float] = (0.0, 1.0)

    @property
    def width(self) -> int:
        return 1 + sum(len(self.edges[n]) for n in self.numbers) + SLOTS * len(self.categories)

    def matrix(self, x: dict[str, np.ndarray]) -> np.ndarray:
        size = len(x[self.numbers[0]])
        parts = [np.ones((size, 1))] + [(x[n][:, None] > self.edges[n]).astype(float) for n in self.numbers]
        for c in self.categories:
            parts.append((x[c][:, None] == np.arange(SLOTS)).astype(float))
        return np.hstack(parts)

    def log_odds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return self.calibration[0] + self.calibration[1] * (self.matrix(x) @ self.weights)


@dataclass
class Model:
    content: View
    metadata: View
    shares: tuple[float, float] = (0.5, 0.5)
    constant: float | None = None

    def scores(self, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, content and metadata probability that a document is good."""
        if self.constant is not None:
            flat = np.full(len(x["words"]), self.constant)
            return flat, flat, flat
        a, b = self.content.log_odds(x), self.metadata.log_odds(x)
        return _sigmoid(self.shares[0] * a + self.shares[1] * b), _sigmoid(a), _sigmoid(b)


def _log_loss(p: np.ndarray, y: np.ndarray, often: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(np.average(-(y * np.log(p) + (1 - y) * np.log(1 - p)), weights=often))


def _rows(x: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[at] for k, v in x.items()}


def _bins(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(raw * BINS), -MOST * BINS, MOST * BINS - 1).astype(np.int64) + MOST * BINS


@dataclass
class Course:
    """The training so far: both views, their weights in past rounds, and the bins from which on rows were taught.

    Rows have features, ``y`` (1 good, 0 bad, NaN without a label) and ``held``
    (a labelled row that calibrates).
    """

    views: tuple[View, View]
    weights: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: by round and teaching view: least bin taught as good, greatest bin taught as bad
    cuts: list[tuple[tuple[int, int], tuple[int, int]]] = field(default_factory=list)

    def taught(self, teacher: int, matrix: np.ndarray) -> np.ndarray:
        """What each row was taught by a view, NaN if nothing; the first round that taught it holds."""
        out = np.full(len(matrix), np.nan)
        for weights, cuts in zip(self.weights, self.cuts):
            bins = _bins(matrix @ weights[teacher])
            free = np.isnan(out)
            out[free & (bins >= cuts[teacher][0])] = 1.0
            out[free & (bins <= cuts[teacher][1])] = 0.0
        return out

    def newton(self, x: Rows, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Gradient and curvature of both views at ``weights``, over labelled rows that are not held and taught ones."""
        known = ~np.isnan(x["y"])
        matrices = [v.matrix(x) for v in self.views]
        parts = []
        for i, w in enumerate(weights):
            y = np.where(known, x["y"], self.taught(1 - i, matrices[1 - i]))
            own = ~np.isnan(y) & ~x["held"]
            a, y = matrices[i][own], y[own]
            p = _sigmoid(a @ w)
            parts += [a.T @ (y - p), ((a * (p * (1 - p))[:, None]).T @ a).ravel()]
        return np.concatenate(parts)

    def confidence(self, x: Rows, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Histogram by view of the log-odds of unlabelled rows that the view has not taught yet."""
        free = _rows(x, np.isnan(x["y"]))
        parts = []
        for i, v in enumerate(self.views):
            matrix = v.matrix(free)
            open_ = np.isnan(self.taught(i, matrix))
            parts.append(np.bincount(_bins(matrix[open_] @ weights[i]), minlength=2 * MOST * BINS).astype(float))
        return np.concatenate(parts)

    def held_rows(self, x: Rows, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Histogram by view and label of the log-odds of held rows."""
        held = _rows(x, x["held"])
        size = 2 * MOST * BINS
        return np.concatenate([np.bincount(_bins(v.matrix(held) @ w) + size * held["y"].astype(np.int64), minlength=2 * size) for v, w in zip(self.views, weights)]).astype(float)


def cut(counts: np.ndarray, most: int, sure: float) -> int:
    """The least bin, from the highest down, whose rows are sure and number at most ``most`` together with those above.

    The highest bin that holds rows counts whole, however many they are.
    """
    least = int(_bins(np.array([np.log(sure / (1 - sure))]))[0]) + 1
    chosen, taken = len(counts), 0
    for bin_ in range(len(counts) - 1, least - 1, -1):
        n = int(counts[bin_])
        if n and taken and taken + n > most:
            break
        if n:
            chosen, taken = bin_, taken + n
    return chosen


#: Adds up what a function makes of all rows, batch by batch.
Total = Callable[[Callable[[Rows], np.ndarray]], np.ndarray]


def co_train_rows(total: Total, edges: dict[str, np.ndarray], rounds: int = ROUNDS, share: float = SHARE, sure: float = SURE) -> Model:
    """Both views trained on labelled rows and on what each is sure of; ``total`` runs over all rows."""
    counted = total(lambda x: np.array([np.isnan(x["y"]).sum(), *(((x["y"] == c) & (x["held"] == h)).sum() for c in (0, 1) for h in (False, True))], float))
    free, bad, held_bad, good, held_good = counted
    model = Model(View(CONTENT), View(LAYOUT, CATEGORIES))
    labelled = counted[1:].sum()
    if labelled < 6 or not bad or not good:
        known_good = good + held_good
        both = labelled >= 6 and 0 < known_good < labelled
        model.constant = None if both else float((known_good + 1) / (labelled + 1)) if labelled else 1.0
        if not both:
            return model
    rate = (good + held_good) / labelled
    for v in (model.content, model.metadata):
        v.edges = {n: edges[n] for n in v.numbers}
    course = Course((model.content, model.metadata))
    weights = tuple(np.zeros(v.width) for v in course.views)
    for turn in range(rounds + 1):
        for _ in range(STEPS_MORE if turn else FIRST_STEPS):
            weights = _stepped(course, total(lambda x, at=weights: course.newton(x, at)), weights)
        if turn == rounds:
            break
        sides = np.split(total(lambda x: course.confidence(x, weights)), 2)
        top = len(sides[0]) - 1
        goods, bads = int(np.ceil(share * free * rate)), int(np.ceil(share * free * (1 - rate)))
        course.weights.append(weights)
        course.cuts.append(tuple((cut(h, goods, sure), top - cut(h[::-1], bads, sure)) for h in sides))
    held = np.split(total(lambda x: course.held_rows(x, weights)), 2)
    base = _log_loss(np.full(2, rate), np.array([0.0, 1.0]), np.array([held_bad, held_good])) if held_bad + held_good else 0.0
    loss = []
    for v, w, counts in zip(course.views, weights, held):
        v.weights = w
        v.calibration, lost = _calibrated(counts)
        loss.append(lost)
    gain = np.maximum(base - np.array(loss), 1e-3)
    model.shares = tuple(gain / gain.max())  # the better view counts in full, the other by what it adds
    return model


def _stepped(course: Course, sums: np.ndarray, weights: tuple[np.ndarray, np.ndarray], ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both views after one Newton step with a ridge penalty (none on the intercepts)."""
    out = []
    for w in weights:
        k = len(w)
        gradient, curvature, sums = sums[:k], sums[k : k + k * k].reshape(k, k), sums[k + k * k :]
        penalty = np.full(k, ridge)
        penalty[0] = 1e-6
        step = np.linalg.solve(curvature + np.diag(penalty + 1e-9), gradient - penalty * w)
        out.append(w + step / max(1.0, float(np.abs(step).max()) / 4))
    return tuple(out)


def _calibrated(counts: np.ndarray) -> tuple[tuple[float, float], float]:
    """Intercept and slope fitted to a histogram of log-odds by label, and the log-loss with them."""
    bad, good = np.split(counts, 2)
    raw = (np.arange(len(bad)) + 0.5) / BINS - MOST
    filled = np.flatnonzero(bad + good)
    bad, good, raw = bad[filled], good[filled], raw[filled]
    a, y = np.stack([np.ones(2 * len(raw)), np.tile(raw, 2)], 1), np.repeat([0.0, 1.0], len(raw))
    often = np.concatenate([bad, good])
    line = (0.0, 1.0)
    if bad.sum() and good.sum():
        line = tuple(fit_logistic(a, y, ridge=1e-2, often=often))
    return line, _log_loss(_sigmoid(a @ np.array(line)), y, often) if often.sum() else 0.0


def co_train(labelled: Rows, good: np.ndarray, pool: Rows, rounds: int = ROUNDS) -> Model:
    """``co_train_rows`` over rows at hand; every fourth labelled row of each class calibrates."""
    y = np.concatenate([np.asarray(good, float), np.full(len(next(iter(pool.values()))), np.nan)])
    held = np.zeros(len(y), bool)
    for c in (0, 1):
        held[np.flatnonzero(y == c)[3::4]] = True
    x = {k: np.concatenate([labelled[k], pool[k]]) for k in labelled} | {"y": y, "held": held}
    edges = {n: _edges(np.quantile(x[n], _LEVELS, method="lower")) for n in NUMBERS}
    return co_train_rows(lambda f: f(x), edges, rounds)


_LEVELS = np.linspace(0, 1, STEPS + 1)[:-1]


def _edges(quantiles) -> np.ndarray:
    return np.unique(np.asarray(quantiles, float))


def _slot(value) -> int:
    return 0 if value is None else 1 + crc32(str(value).encode()) % (SLOTS - 1)


def _size(docs: DataFrame) -> F.Column:
    return F.col("n_chars").cast("double") if "n_chars" in {c.lower() for c in docs.columns} else F.lit(None).cast("double")


def _category(docs: DataFrame, name: str) -> F.Column:
    return F.col(name).cast("string") if name in {c.lower() for c in docs.columns} else F.lit(None).cast("string")


def features_of(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``id``, ``y`` (mean label >= 0.5; null without one), ``held`` and the features of each row."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("said"), _size(docs).alias("size"), *(_category(docs, c).alias(f"{c}_of") for c in CATEGORIES)
    )
    keep = ("size", *(f"{c}_of" for c in CATEGORIES))
    counted = text_counts(rows, "id", "said", keep)
    numbers = ratios() | {"lines": F.col("counts.n_lines").cast("double"), "chars": F.coalesce("size", F.lit(-1.0))}
    slots = {c: F.coalesce(F.crc32(f"{c}_of") % (SLOTS - 1) + 1, F.lit(0)).cast("int") for c in CATEGORIES}
    made = counted.select("id", *(numbers[n].alias(n) for n in NUMBERS), *(s.alias(c) for c, s in slots.items()))
    if labels is None:
        return made
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    truth = store(known.groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y")))
    if truth.count() <= BROADCAST_KEYS:
        truth = F.broadcast(truth)
    held = F.col("y").isNotNull() & (F.crc32(F.concat(F.lit("held:"), F.col("id").cast("string"))) % 4 == 3)
    return made.join(truth, "id", "left").withColumn("held", held)


def _arrays(batch: pa.RecordBatch) -> Rows:
    x = {n: np.nan_to_num(batch.column(n).to_numpy(zero_copy_only=False)) for n in NUMBERS}
    x |= {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in CATEGORIES}
    if "y" in batch.schema.names:
        x["y"] = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        x["held"] = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
    return x


def learn_from(features: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model from stored rows of ``features_of`` with labels."""

    def total(of: Callable[[Rows], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = None
            for batch in batches:
                if batch.num_rows:
                    own = of(_arrays(batch))
                    made = own if made is None else made + own
            if made is not None:
                at = np.flatnonzero(made)
                yield pa.record_batch([pa.array(at, pa.int32()), pa.array(made[at]), pa.array(np.full(len(at), len(made)), pa.int32())], ["at", "v", "size"])

        summed = features.drop("id").mapInArrow(run, "at int, v double, size int").groupBy("at", "size").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(summed.column("size")[0].as_py() if len(summed) else 0)
        out[summed.column("at").to_numpy()] = summed.column("v").to_numpy()
        return out

    levels = F.array(*(F.lit(float(q)) for q in _LEVELS))
    edges = features.agg(*(F.percentile_approx(n, levels, 10_000).alias(n) for n in NUMBERS)).first()
    if edges[NUMBERS[0]] is None:  # no rows
        return Model(View(CONTENT), View(LAYOUT, CATEGORIES), constant=1.0)
    return co_train_rows(total, {n: _edges(edges[n]) for n in NUMBERS}, rounds)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rounds: int = ROUNDS) -> Model:
    """The model from labelled rows and all others."""
    return learn_from(store(features_of(docs, labels, id_col, text_col, label_col)), rounds)


def score_features(features: DataFrame, model: Model, id_col: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """``id_col, score, content_score, metadata_score, kept`` of each row of ``features_of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, content, metadata = model.scores(_arrays(batch))
            made = {"score": both, "content_score": content, "metadata_score": metadata, "kept": both >= threshold}
            yield pa.RecordBatch.from_pydict({id_col: batch.column("id")} | {k: pa.array(v) for k, v in made.items()})

    fields = [T.StructField(n, T.DoubleType()) for n in ("score", "content_score", "metadata_score")]
    own = T.StructField(id_col, features.schema["id"].dataType)
    return features.select("id", *NUMBERS, *CATEGORIES).mapInArrow(run, T.StructType([own, *fields, T.StructField("kept", T.BooleanType())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id_col, score, content_score, metadata_score, kept`` of each row."""
    return score_features(features_of(docs, None, id_col, text_col), model, id_col, threshold)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they were, in one pass over the texts."""
    names = {c.lower(): c for c in docs.columns}
    size = names.get("n_chars")
    columns = {c: names.get(c) for c in CATEGORIES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in slices(batches, text_col):
            counts = [counter.counts(t) if t else EMPTY for t in batch.column(text_col).to_pylist()]
            x = ratio_arrays(counts)
            chars = batch.column(size).cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False) if size else np.full(len(counts), -1.0)
            x |= {"lines": np.array([c[5] for c in counts], float), "chars": np.nan_to_num(chars)}
            for c, own in columns.items():
                x[c] = np.array([_slot(v) for v in batch.column(own).to_pylist()] if own else [0] * len(counts), np.int64)
            yield batch.filter(pa.array(model.scores(x)[0] >= threshold))

    return docs.mapInArrow(run, docs.schema)
