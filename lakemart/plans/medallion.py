"""The bronze → silver → gold refresh as an ordered list of dataset builders.

``build`` returns every dataset lazily (after its drop rules) so that any one
of them can be queried or explained; ``quality_report`` counts all 19 rules;
``run`` writes the tables in dependency order, each write computing its own
rule counters through ``DataFrame.observe`` (no extra pass).

Re-use across writes: five datasets read the cleaned view. ``run`` stores it
once as Parquet in the shared folder, so the de-duplication shuffle runs once,
and the gold marts read the silver tables that were just written rather than
recomputing them. ``Datasets`` stores of the view what the wanted datasets read.

The quality report reads the cleaned lines once: each line is counted against the
fact's rules on its way, and stands in one group of each family of datasets, all of
which one grouping adds up (``grouped_lines``); dimensions and marts are read from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DIM_COLUMNS, FACT_COLUMNS, Layers
from ..operators import marts, star
from ..operators.quality import (
    Expectation,
    apply_expectations,
    conformity,
    conformity_row,
    kept_condition,
    observation_rows,
    observe_rules,
    rule_counts,
    rules_for,
)
from ..session import store
from ..sinks import write_table


@dataclass(frozen=True)
class DatasetDef:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame] | None
    comment: str

    @property
    def rules(self) -> tuple[Expectation, ...]:
        return rules_for(self.name)


DATASETS: tuple[DatasetDef, ...] = (
    DatasetDef("sales_raw", "bronze", (), None,
               "Raw sales lines as ingested, with ingestion time and source file"),
    DatasetDef("sales_cleaned_view", "view", ("sales_raw",), star.sales_cleaned,
               "De-duplicated, cleaned and typed sales lines"),
    DatasetDef("dim_produto", "silver", ("sales_cleaned_view",), star.dim_produto,
               "Product dimension"),
    DatasetDef("dim_cliente", "silver", ("sales_cleaned_view",), star.dim_cliente,
               "Customer dimension"),
    DatasetDef("dim_localizacao", "silver", ("sales_cleaned_view",), star.dim_localizacao,
               "Location dimension"),
    DatasetDef("dim_modo_envio", "silver", ("sales_cleaned_view",), star.dim_modo_envio,
               "Ship mode and order priority dimension"),
    DatasetDef("ft_vendas", "silver", ("sales_cleaned_view",), star.ft_vendas,
               "Sales fact with key, sign and range rules"),
    DatasetDef("vendas_por_categoria", "gold", ("ft_vendas", "dim_produto"),
               marts.vendas_por_categoria, "KPIs by category and sub-category"),
    DatasetDef("desempenho_regional", "gold", ("ft_vendas", "dim_localizacao"),
               marts.desempenho_regional, "KPIs by market, region and country"),
    DatasetDef("metrica_clientes", "gold", ("ft_vendas", "dim_cliente"),
               marts.metrica_clientes, "Customer and segment KPIs"),
)

REPORT_SCHEMA = "dataset string, rule string, action string, predicate string, total_rows long, passed long, failed long"
BY_NAME = {d.name: d for d in DATASETS}


def fact_columns(marts_wanted: Iterable[str]) -> set[str]:
    """Columns of the fact that its rules and the given marts read."""
    read = {c for m in marts_wanted for c in marts.MART_READS[m]}
    return read.union(*(r.columns(FACT_COLUMNS) for r in rules_for("ft_vendas") if r.action == "drop"))


def view_columns(wanted: Iterable[str]) -> set[str] | None:
    """Columns of the cleaned view from which the wanted datasets can be built; None for all."""
    wanted = set(wanted)
    if "sales_cleaned_view" in wanted:
        return None
    out: set[str] = set()
    for name in wanted:
        if name in marts.MART_READS:
            out |= fact_columns([name])
            out.update(*(DIM_COLUMNS[i] for i in BY_NAME[name].inputs if i in DIM_COLUMNS))
        elif name == "ft_vendas":
            out |= set(FACT_COLUMNS)
        else:
            out |= set(DIM_COLUMNS.get(name, ()))
    return out


class Datasets:
    """Lazily built datasets of one refresh; each is built once, on first use.

    ``pre(name)`` is a dataset before its own drop rules (its inputs are
    already filtered); ``[name]`` is the dataset as published. With
    ``store_view`` the raw lines are stored once (the de-duplication reads them
    three times), counted against their rules in that pass, and so are the
    columns of the cleaned view that the ``wanted`` datasets read.
    """

    def __init__(self, bronze: DataFrame, store_view: bool = False, wanted: Iterable[str] | None = None):
        self._bronze = bronze
        self._store = store_view
        self._wanted = None if wanted is None else set(wanted)
        self.observed: dict[str, Observation] = {}
        self._pre: dict[str, DataFrame] = {}
        self._post: dict[str, DataFrame] = {}

    def _view(self, d: DatasetDef) -> DataFrame:
        if not self._store:
            return d.build(self._bronze)
        view = d.build(self.stored_bronze())
        columns = None if self._wanted is None else view_columns(self._wanted)
        if columns is not None:
            view = view.select(*[c for c in view.columns if c in columns])
        return view

    def stored_bronze(self) -> DataFrame:
        if "stored" not in self._pre:
            raw, self.observed["sales_raw"] = observe_rules(self._bronze, rules_for("sales_raw"), "sales_raw")
            self._pre["stored"] = store(raw)
        return self._pre["stored"]

    def _build(self, d: DatasetDef) -> DataFrame:
        if d.build is None:
            return self._bronze
        if d.layer == "view":
            return self._view(d)
        inputs = [self[i] for i in d.inputs]
        if d.name == "ft_vendas":
            return star.ft_vendas(*inputs, [c for c in FACT_COLUMNS if c in inputs[0].columns])
        return d.build(*inputs)

    def pre(self, name: str) -> DataFrame:
        if name not in self._pre:
            self._pre[name] = self._build(BY_NAME[name])
        return self._pre[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._post:
            self._post[name] = apply_expectations(self.pre(name), BY_NAME[name].rules)
        return self._post[name]

    def __contains__(self, name: str) -> bool:
        return name in BY_NAME

    def keys(self):
        return BY_NAME.keys()

    def items(self):
        return ((n, self[n]) for n in BY_NAME)


def build(bronze: DataFrame, store_view: bool = False, wanted: Iterable[str] | None = None) -> Datasets:
    """Every dataset as published (after its drop rules), built on first access."""
    return Datasets(bronze, store_view, wanted)


DIMS = tuple(DIM_COLUMNS)
#: Datasets that are counted from the same groups of lines when they are wanted together.
FAMILIES = (
    ("vendas_por_categoria", "dim_produto"),
    ("desempenho_regional", "metrica_clientes", "dim_cliente", "dim_localizacao"),
    ("dim_modo_envio",),
)


def _columns(name: str) -> tuple[str, ...]:
    return DIM_COLUMNS.get(name) or marts.MART_GROUPS[name]


def families(names: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """For each named dataset the columns of the groups it is read from.

    Dimensions share the groups of a mart, whose keys say most of theirs; without
    a mart a dimension has groups of its own, which are the fewer.
    """
    names = set(names)
    out = {}
    for family in FAMILIES:
        wanted = [n for n in family if n in names]
        shared = tuple(dict.fromkeys(c for n in wanted for c in _columns(n)))
        out |= {n: shared if any(w in marts.MART_GROUPS for w in wanted) else _columns(n) for n in wanted}
    return out


def grouped_lines(cleaned: DataFrame, names: Iterable[str]) -> DataFrame:
    """Groups of the lines from which the named dimensions and marts are read, from one pass over the lines.

    ``dataset`` (the columns of a group, joined), ``k0 ...``, the number of lines that the fact
    keeps, and the sums of its measures over those. A line stands in one group of each
    family; the grouping combines before its shuffle. ``dimension_of`` and
    ``groups_of`` read a dataset.
    """
    names = list(names)
    columns = list(dict.fromkeys(families(names).values()))
    width = max(map(len, columns))
    kept = kept_condition(rules_for("ft_vendas"))
    tags = []
    for own in columns:
        keys = [F.col(own[i]) if i < len(own) else F.lit(None).cast("string") for i in range(width)]
        tags.append(F.struct(F.lit(",".join(own)).alias("dataset"), *(k.alias(f"k{i}") for i, k in enumerate(keys))))
    measures = sorted({c for n in names for c in marts.MART_READS.get(n, ())} - set().union(*marts.MART_GROUPS.values()))
    tagged = cleaned.select(F.explode(F.array(*tags)).alias("_tag"), kept.alias("_kept"), *(F.when(kept, F.col(c)).alias(c) for c in measures))
    rows = tagged.select("_tag.*", "_kept", *measures)
    return rows.groupBy("dataset", *(f"k{i}" for i in range(width))).agg(F.count_if("_kept").alias("n_lines"), *marts.totals(measures))


def _family(grouped: DataFrame, own: tuple[str, ...]) -> DataFrame:
    rows = grouped.filter(F.col("dataset") == ",".join(own))
    return rows.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(own)), *(c for c in grouped.columns if c.startswith(("s_", "n_"))))


def dimension_of(grouped: DataFrame, name: str, names: Iterable[str]) -> DataFrame:
    """The dimension ``name`` of the groups of ``names``."""
    return _family(grouped, families(names)[name]).select(*DIM_COLUMNS[name]).distinct()


def groups_of(grouped: DataFrame, name: str, names: Iterable[str]) -> DataFrame:
    """Groups of the mart ``name``; its keys may come in several, which its sums and distinct counts add up."""
    rows = _family(grouped, families(names)[name]).filter(F.col("n_lines") > 0)
    return rows.select(*marts.MART_GROUPS[name], *(c for c in grouped.columns if c.startswith(("s_", "n_"))))


def _read_once(bronze: DataFrame, names: Iterable[str], store_view: bool) -> tuple[DataFrame, dict[str, Observation]]:
    """Stored groups of the named datasets, and the counters of the raw lines and the fact that the same passes took."""
    ds = Datasets(bronze, store_view)
    raw = ds.stored_bronze() if store_view else bronze
    fact, seen = observe_rules(star.sales_cleaned(raw), rules_for("ft_vendas"), "ft_vendas")
    grouped = store(grouped_lines(fact, names))
    return grouped, ds.observed | {"ft_vendas": seen}


def quality_report(bronze: DataFrame, store_view: bool = False) -> DataFrame:
    """All rules of all datasets: ``dataset, rule, action, predicate, total_rows, passed, failed``.

    ``store_view``: the raw lines are a plan rather than a table, so they are
    stored first, and their rules are counted in that pass.
    """
    names = [*DIMS, *marts.KPIS]
    grouped, observed = _read_once(bronze, names, store_view)
    frames = {"sales_raw": bronze} | {n: dimension_of(grouped, n, names) for n in DIMS}
    for name, kpis in marts.KPIS.items():
        (dim,) = (i for i in BY_NAME[name].inputs if i in DIM_COLUMNS)
        frames[name] = kpis(groups_of(grouped, name, names), apply_expectations(frames[dim], rules_for(dim)))
    rows, parts = [], []
    for d in DATASETS:
        if d.name in observed:
            rows += observation_rows(d.name, d.rules, observed[d.name].get)
        elif d.rules:
            parts.append(rule_counts(frames[d.name], d.rules, d.name))
    return reduce(DataFrame.unionByName, [bronze.sparkSession.createDataFrame(rows, REPORT_SCHEMA), *parts])


def conformity_report(bronze: DataFrame, store_view: bool = False) -> DataFrame:
    """Kept and dropped rows of every dataset that has a drop rule."""
    grouped, observed = _read_once(bronze, DIMS, store_view)
    fact = conformity_row(bronze.sparkSession, "ft_vendas", observed["ft_vendas"].get)
    return reduce(DataFrame.unionByName, [conformity(dimension_of(grouped, n, DIMS), rules_for(n), n) for n in DIMS], fact)


def table_name(layers: Layers, d: DatasetDef) -> str:
    return f"{getattr(layers, d.layer)}.{d.name}"


def run(spark: SparkSession, bronze: DataFrame, layers: Layers = Layers()) -> DataFrame:
    """Full refresh: write every table in order; return the rule counts observed."""
    rows: list[tuple] = []
    stored: dict[str, DataFrame] = {}
    for d in DATASETS:
        if d.name == "sales_raw":
            frame = bronze
        elif d.layer == "view":
            cleaned = d.build(*[stored[i] for i in d.inputs])
            stored[d.name] = store(cleaned)
            stored[d.name].createOrReplaceTempView(d.name)
            continue
        else:
            frame = d.build(*[stored[i] for i in d.inputs])
        if d.layer == "gold":
            frame = marts.by_revenue(frame, *marts.MART_KEYS[d.name])
        observed, obs = observe_rules(frame, d.rules, d.name) if d.rules else (frame, None)
        name = table_name(layers, d)
        write_table(apply_expectations(observed, d.rules), name, d.comment, layers.table_format)
        if obs is not None:
            rows += observation_rows(d.name, d.rules, obs.get)
        stored[d.name] = spark.read.table(name)
    return spark.createDataFrame(rows, REPORT_SCHEMA)
