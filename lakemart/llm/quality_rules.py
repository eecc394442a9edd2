"""Quality rules: a decision list learned by sequential covering.

Counts of each text (``textstats``) give interpretable ratios. From labelled
rows the learner grows one rule at a time: a conjunction of thresholds, each
step adding the one with the highest information gain on two thirds of the
rows still uncovered, then dropping conditions from the end while precision on
the other third does not fall. A rule that is precise enough joins the list,
the rows it covers leave, and the search goes on. The list becomes one ordered
Spark conditional expression, so judging all documents stays in the JVM.

Labels are read from at most ``sample_rows`` labelled documents, those with
the lowest hash of their id; everything else covers all rows.

Defined cases: null and empty texts have all counts 0 and fail the base;
documents with contradicting labels count by their mean; without labels of
both classes the list is empty and the base alone decides; repeated rows each
give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textstats import ratios, text_counts

SAMPLE_ROWS = 20_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        c = features[self.feature]
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Rows that meet all conditions are rejected."""

    conditions: tuple[Condition, ...]
    precision: float
    support: int

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x[c.feature]) for c in self.conditions])

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.conditions))} (precision {self.precision:.2f}, {self.support} rows)"


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, max_conditions: int, cuts: int) -> list[Condition]:
    """Add the condition of the highest gain until no good row is covered."""
    found: list[Condition] = []
    while len(found) < max_conditions and rows.any() and not bad[rows].all():
        p, n = bad[rows].sum(), (~bad[rows]).sum()
        if not p:
            break
        before, best = np.log2(p / (p + n)), (0.0, None)
        for name, values in x.items():
            v, b = values[rows], bad[rows]
            order = v.argsort(kind="stable")
            v, b = v[order], b[order]
            ends = np.flatnonzero(np.diff(v) > 0)  # a cut lies between two different values
            if not len(ends):
                continue
            if len(ends) > cuts:
                ends = ends[np.linspace(0, len(ends) - 1, cuts).astype(int)]
            at = v[ends] + (v[ends + 1] - v[ends]) / 2
            low_p = np.cumsum(b)[ends].astype(float)
            low_n = ends + 1 - low_p
            for above, pp, nn in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - before), 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), Condition(name, above, float(at[k])))
        if best[1] is None:
            break
        found.append(best[1])
        rows = rows & best[1].holds(x[best[1].feature])
    return found


def _precision(conditions: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Laplace-smoothed share of bad rows among those covered, and how many these are."""
    for c in conditions:
        rows = rows & c.holds(x[c.feature])
    n = int(rows.sum())
    return (float(bad[rows].sum()) + 1) / (n + 2), n


def learn(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = 0.75,
    min_support: int = 3,
    max_rules: int = 24,
    max_conditions: int = 4,
    cuts: int = 128,
    seed: int = 7,
) -> list[Rule]:
    """Ordered rules that tell bad rows, from columns ``x`` and the label ``bad``."""
    bad = np.asarray(bad, bool)
    left = np.ones(len(bad), bool)
    part = np.random.default_rng(seed).permutation(len(bad)) % 3
    rules: list[Rule] = []
    fails = 0
    while len(rules) < max_rules and fails < 3 and bad[left].any() and not bad[left].all():
        growing, pruning = left & (part != fails % 3), left & (part == fails % 3)
        conditions = _grow(x, bad, growing, max_conditions, cuts)
        best = _precision(conditions, x, bad, pruning)[0] if conditions else 0.0
        while len(conditions) > 1 and (shorter := _precision(conditions[:-1], x, bad, pruning)[0]) >= best:
            conditions, best = conditions[:-1], shorter
        overall, support = _precision(conditions, x, bad, left) if conditions else (0.0, 0)
        if support < min_support or min(overall, max(best, 0.5)) < min_precision and overall < min_precision + 0.1:
            fails += 1  # try another split before giving up
            continue
        rule = Rule(tuple(conditions), overall, support)
        rules.append(rule)
        left &= ~rule.covers(x)
        fails = 0
    return rules


def keeps(rules: list[Rule], features: dict[str, Column]) -> Column:
    """The list as one ordered conditional: false at the first rule met, else true."""
    out = None
    for rule in rules:
        met = rule.conditions[0].column(features)
        for c in rule.conditions[1:]:
            met = met & c.column(features)
        out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    words, again = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    return (words < 50) | (100 * again > 50 * words)


def labelled_sample(labels: DataFrame, label_col: str, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, those of the lowest hash, with the mean of their labels."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    mean = known.groupBy(id_col).agg(F.avg(label_col).alias("label_mean"))
    return mean.orderBy(F.xxhash64(id_col), id_col).limit(rows)


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **options) -> list[Rule]:
    """Rules from the labelled rows that pass the base."""
    sample = labelled_sample(labels, label_col, id_col, sample_rows)
    own = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)  # at most sample_rows ids
    features = ratios()
    counted = text_counts(own, id_col, text_col, ("label_mean",)).filter(~base_failed())
    rows = counted.select((F.col("label_mean") < 0.5).alias("bad"), *(c.alias(n) for n, c in features.items())).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")  # the same list whatever order rows came in
    return learn({n: rows[n].to_numpy(float) for n in features}, rows["bad"].to_numpy(bool), **options)


def apply_rules(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, counts, base_failed, kept`` of each row."""
    counted = text_counts(docs, id_col, text_col).withColumn("base_failed", base_failed())
    return counted.withColumn("kept", ~F.col("base_failed") & keeps(rules, ratios()))
