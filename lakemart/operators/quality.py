"""Named data-quality expectations: count violations, optionally drop rows.

An ``Expectation`` is a name, a SQL predicate and an action. ``warn`` keeps
every row and only counts; ``drop`` keeps a row only when the predicate is
TRUE (NULL counts as a failure, as ``filter`` does). Counts are always taken
over the dataset's rows before any drop.

Counting never needs a pass of its own: ``rule_counts`` is one aggregate of
``count_if`` columns (partial aggregation, one output row), and
``observe_rules`` attaches the same counters to the pass that writes the
dataset through ``DataFrame.observe``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import QUALITY_RULES

WARN = "warn"
DROP = "drop"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP):
            raise ValueError(f"action must be 'warn' or 'drop', got {self.action!r}")

    def passes(self) -> Column:
        """TRUE when the row satisfies the rule; NULL predicates fail."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


    def columns(self, available: Iterable[str]) -> set[str]:
        """Which of the available columns the predicate reads."""
        words = set(re.findall(r"\w+", self.predicate))
        return {c for c in available if c in words}


def rules_for(dataset: str) -> tuple[Expectation, ...]:
    return tuple(Expectation(n, p, a) for d, n, p, a in QUALITY_RULES if d == dataset)


def apply_expectations(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """Keep the rows that pass every ``drop`` rule (``warn`` rules keep all)."""
    drops = [F.expr(r.predicate) for r in rules if r.action == DROP]
    if not drops:
        return df
    return df.filter(reduce(lambda a, b: a & b, drops))


def kept_condition(rules: Iterable[Expectation]) -> Column:
    drops = [r.passes() for r in rules if r.action == DROP]
    return reduce(lambda a, b: a & b, drops, F.lit(True))


def rule_counts(df: DataFrame, rules: Sequence[Expectation], dataset: str) -> DataFrame:
    """One row per rule: ``dataset, rule, action, predicate, total_rows, passed, failed``.

    A single aggregate computes every rule's pass count and the kept-row count,
    then ``stack`` turns the one wide row into one row per rule.
    """
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(r.passes()).alias(f"p{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    pieces = ", ".join(
        f"{_sql_str(r.name)}, {_sql_str(r.action)}, {_sql_str(r.predicate)}, p{i}"
        for i, r in enumerate(rules)
    )
    long = wide.selectExpr(
        "total_rows", f"stack({len(rules)}, {pieces}) AS (rule, action, predicate, passed)"
    )
    return long.select(
        F.lit(dataset).alias("dataset"),
        "rule",
        "action",
        "predicate",
        "total_rows",
        "passed",
        (F.col("total_rows") - F.col("passed")).alias("failed"),
    )


def conformity(df: DataFrame, rules: Sequence[Expectation], dataset: str) -> DataFrame:
    """Rows in, rows kept by the drop rules, and the two rates in percent."""
    agg = df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(kept_condition(rules)).alias("kept_rows"),
    )
    return _rates(agg, dataset)


def conformity_row(spark: SparkSession, dataset: str, values: dict) -> DataFrame:
    """``conformity`` from counters that ``observe_rules`` took."""
    counted = [(int(values.get("total_rows", 0)), int(values.get("kept_rows", 0)))]
    return _rates(spark.createDataFrame(counted, "input_rows long, kept_rows long"), dataset)


def _rates(agg: DataFrame, dataset: str) -> DataFrame:
    return agg.select(
        F.lit(dataset).alias("dataset"),
        "input_rows",
        "kept_rows",
        (F.col("input_rows") - F.col("kept_rows")).alias("dropped_rows"),
        F.round(F.try_divide(F.col("kept_rows") * 100.0, F.col("input_rows")), 1).alias("conformity_pct"),
        F.round(
            F.try_divide((F.col("input_rows") - F.col("kept_rows")) * 100.0, F.col("input_rows")), 1
        ).alias("anomaly_pct"),
    )


def observe_rules(df: DataFrame, rules: Sequence[Expectation], dataset: str) -> tuple[DataFrame, Observation]:
    """Attach the rule counters to ``df`` so the writing pass computes them.

    Read ``observation.get`` after the action that consumes the returned frame.
    """
    obs = Observation(f"quality_{dataset}")
    exprs = [F.count(F.lit(1)).alias("total_rows"), F.count_if(kept_condition(rules)).alias("kept_rows")]
    exprs += [F.count_if(r.passes()).alias(r.name) for r in rules]
    return df.observe(obs, *exprs), obs


def observation_rows(dataset: str, rules: Sequence[Expectation], values: dict) -> list[tuple]:
    total = int(values.get("total_rows", 0))
    out = []
    for r in rules:
        passed = int(values.get(r.name, 0))
        out.append((dataset, r.name, r.action, r.predicate, total, passed, total - passed))
    return out


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
