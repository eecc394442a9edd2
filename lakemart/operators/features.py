"""Per-customer recency / frequency / value features at one or many cutoffs.

The reference loops over customers in Python, and over cutoffs around that.
Here no line is ever copied per cutoff. Each line belongs to one bucket, that
of the first cutoff on or after its date (an equi-join with the calendar days
between the cutoffs); lines are aggregated per ``(customer, bucket)``, and a
customer's features at a cutoff are running totals over the buckets up to it.
Distinct counts come from the first bucket in which a value appears, modes
from the running count of each value. A row of running totals then stands for
every cutoff up to the customer's next bucket. The number of cutoffs thus only
affects the size of the result.

All aggregates combine partially before the shuffle. The windows by customer
see one row per bucket, and one per bucket and segment or market; order and
product ids only meet hash aggregates, spread by customer and id (current
features: those of a customer of more than ``MANY_LINES`` lines). So a customer
holding a third of the lines does not put a third of anything into one task.
Sums and means are exact (``exact_sum``), so the rounded features do not depend
on how the partitions were combined.

``customer_features_current`` uses the latest order date in the data as the
reference date: a one-row aggregate, broadcast onto the per-customer rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SCRIPT_FEATURES, FeatureSpec
from ..functions.numeric import WIDE, exact_sum, round_half_even, safe_ratio
from ..schemas import CUTOFF_SCHEMA

FEATURE_COLUMNS_SCRIPT = (
    "customer_name", "segment", "market", "recencia_dias", "frequencia_pedidos",
    "valor_total_gasto", "quantidade_itens", "ticket_medio", "lucro_total",
    "desconto_medio", "margem_media", "qtd_categorias_distintas",
    "qtd_subcategorias_distintas", "qtd_produtos_distintos",
    "tempo_relacionamento_dias", "data_primeira_compra", "data_ultima_compra",
)
FEATURE_COLUMNS_NOTEBOOK = tuple(
    c for c in FEATURE_COLUMNS_SCRIPT if c not in ("qtd_subcategorias_distintas", "qtd_produtos_distintos")
)


def feature_columns(spec: FeatureSpec) -> tuple[str, ...]:
    return FEATURE_COLUMNS_SCRIPT if spec.extended else FEATURE_COLUMNS_NOTEBOOK


def cutoff_frame(
    spark: SparkSession,
    cutoffs: Sequence[str | dt.date],
    horizon_days: int | Sequence[int] = 90,
) -> DataFrame:
    """The cutoff list as a small frame ``(cutoff date, horizon_days int)``."""
    horizons = [horizon_days] * len(cutoffs) if isinstance(horizon_days, int) else list(horizon_days)
    if len(horizons) != len(cutoffs):
        raise ValueError("one horizon per cutoff")
    rows = [
        (c if isinstance(c, dt.date) else dt.date.fromisoformat(str(c)), int(h))
        for c, h in zip(cutoffs, horizons)
    ]
    return spark.createDataFrame(rows, CUTOFF_SCHEMA)


def with_order_date(sales: DataFrame) -> DataFrame:
    """Order date as DATE (ISO text is parsed; a bad date fails the job, as in pandas)."""
    if dict(sales.dtypes)["order_date"] != "date":
        sales = sales.withColumn("order_date", F.to_date("order_date"))
    return sales


def conform(sales: DataFrame) -> DataFrame:
    """Order date as DATE and no line without a customer (pandas drops them in ``groupby``)."""
    return with_order_date(sales).filter(F.col("customer_name").isNotNull())


def modal_value(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent non-NULL ``column`` per ``keys``; ties go to the smallest value.

    Two hash aggregates: count per ``(keys, value)``, then keep the pair with
    the highest count (smallest value on ties). The second one only sees one
    row per distinct value of a key, so a hot key stays cheap. This keeps
    ``mode`` out of the big distinct-count aggregate, where it would force a
    sort-based plan over every expanded row.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias("_m"))
    return best.select(*keys, F.col("_m.v").alias(column))


def _with_modes(agg: DataFrame, rows: DataFrame, keys: Sequence[str], spec: FeatureSpec) -> DataFrame:
    out = agg
    for column, default in (("segment", spec.default_segment), ("market", spec.default_market)):
        if column in rows.columns:
            out = out.join(modal_value(rows, keys, column), list(keys), "left")
            out = out.withColumn(column, F.coalesce(F.col(column), F.lit(default)))
        else:
            out = out.withColumn(column, F.lit(default))
    return out


def _means(agg: DataFrame) -> DataFrame:
    """Sums and counts to the value columns that ``_finish`` rounds."""
    return agg.withColumns(
        {
            "_value": F.coalesce("_sales", F.lit(0.0)),
            "_profit": F.coalesce("_profit", F.lit(0.0)),
            "_discount": F.try_divide("_discount", "_n_discount"),
            "_margin": F.try_divide("_margin", "_n_margin"),
        }
    )


def _distincts(cols: Sequence[str], spec: FeatureSpec) -> dict[str, tuple[str, int | None]]:
    """Distinct-count feature: its column, and the constant used where the column is absent."""
    wanted = {"frequencia_pedidos": ("order_id", None), "qtd_categorias_distintas": ("category", spec.default_category_count)}
    if spec.extended:
        wanted |= {"qtd_subcategorias_distintas": ("sub_category", spec.default_category_count), "qtd_produtos_distintos": ("product_id", 1)}
    return {f: (c, None if c in cols else d) for f, (c, d) in wanted.items()}


def _aggregates() -> list[Column]:
    return [
        F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"),
        exact_sum(F.col("sales")).alias("_sales"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantidade_itens"),
        exact_sum(F.col("profit")).alias("_profit"),
        exact_sum(F.col("discount")).alias("_discount"),
        F.count("discount").alias("_n_discount"),
        exact_sum(F.col("margem_lucro")).alias("_margin"),
        F.count("margem_lucro").alias("_n_margin"),
    ]


def _finish(agg: DataFrame, ref: Column, spec: FeatureSpec, lead: Sequence[Column]) -> DataFrame:
    derived = {
        "recencia_dias": F.datediff(ref, F.col("_last")).cast("long"),
        "valor_total_gasto": round_half_even(F.col("_value").cast("double"), 2),
        "ticket_medio": round_half_even(
            safe_ratio(F.col("_value").cast("double"), F.col("frequencia_pedidos"), 0.0), 2
        ),
        "lucro_total": round_half_even(F.col("_profit").cast("double"), 2),
        "desconto_medio": round_half_even(F.col("_discount"), 4),
        "margem_media": round_half_even(F.col("_margin"), 4),
        "tempo_relacionamento_dias": F.datediff(F.col("_last"), F.col("_first")).cast("long"),
        "data_primeira_compra": F.date_format("_first", "yyyy-MM-dd"),
        "data_ultima_compra": F.date_format("_last", "yyyy-MM-dd"),
    }
    cols = [derived[c].alias(c) if c in derived else F.col(c) for c in feature_columns(spec)]
    return agg.select(*lead, *cols)


def with_bucket(sales: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``_bucket``: number (from 1) of the first cutoff on or after the order date.

    Lines after the last cutoff get the number of cutoffs plus 1. The lookup
    holds one row per calendar day between the first and the last cutoff.
    """
    in_order = Window.orderBy("cutoff")  # over the caller's list of cutoffs
    numbered = cutoffs.select("cutoff").distinct().select(
        "cutoff", F.row_number().over(in_order).alias("_bucket"), F.lag("cutoff").over(in_order).alias("_before")
    )
    days = numbered.filter(F.col("_before").isNotNull()).select(
        F.explode(F.sequence(F.date_add("_before", 1), F.col("cutoff"))).alias("order_date"), "_bucket"
    )
    ends = numbered.agg(F.min("cutoff").alias("_low"), F.max("cutoff").alias("_high"), F.count(F.lit(1)).alias("_beyond"))
    return (
        sales.crossJoin(F.broadcast(ends))  # one row
        .join(days, "order_date", "left")
        .withColumn(
            "_bucket",
            F.when(F.col("order_date") <= F.col("_low"), F.lit(1))
            .when(F.col("order_date") > F.col("_high"), (F.col("_beyond") + 1).cast("int"))
            .otherwise(F.col("_bucket")),
        )
        .drop("_low", "_high", "_beyond")
    )


def _pairs(lines: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("customer_name", "_bucket")) -> DataFrame:
    """``keys, _column, _value``: one row per line and non-NULL value of each column."""
    pairs = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value")) for c in columns]
    long = lines.select(*keys, F.explode(F.array(*pairs)).alias("_pair")).select(*keys, "_pair.*")
    return long.filter(F.col("_value").isNotNull())


#: Lines from which on a customer's values are not brought together in one task.
MANY_LINES = 100_000


def _value_counts(sales: DataFrame, distinct: dict[str, str]) -> DataFrame:
    """``customer_name`` and, for each feature, how many different values its column has there.

    A distinct count of several columns in one aggregate makes a row of every line
    and column, few of which combine before the shuffle. So the lines themselves are
    dealt out by customer, once, and the values of a customer are told apart in
    its task; those of a customer of ``MANY_LINES`` lines are spread by value.
    """
    columns = list(dict.fromkeys(distinct.values()))
    lines = sales.select("customer_name", *columns)
    numbers = lines.groupBy("customer_name").agg(F.count(F.lit(1)).alias("_lines"))
    many = F.broadcast(numbers.filter(F.col("_lines") > MANY_LINES).select("customer_name"))  # of 100,000 lines at most one
    together = lines.join(many, "customer_name", "left_anti").repartition("customer_name")
    few = together.groupBy("customer_name").agg(*(F.size(F.collect_set(c)).cast("long").alias(f) for f, c in distinct.items()))
    spread = _pairs(lines.join(many, "customer_name", "left_semi"), columns, ["customer_name"]).distinct()
    counts = (F.count_if(F.col("_column") == c).alias(f) for f, c in distinct.items())
    return few.unionByName(spread.groupBy("customer_name").agg(*counts))


def _new_values(lines: DataFrame, distinct: dict[str, str]) -> DataFrame:
    """``customer_name, _bucket`` and, for each feature, how many values of its column the customer first has there.

    The first bucket of a value is a minimum of numbers: a hash aggregate that
    combines before the shuffle, over which no window has to sort.
    """
    columns = list(dict.fromkeys(distinct.values()))
    first = _pairs(lines, columns).groupBy("customer_name", "_column", "_value").agg(F.min("_bucket").alias("_bucket"))
    return first.groupBy("customer_name", "_bucket").agg(*(F.count_if(F.col("_column") == c).alias(f) for f, c in distinct.items()))


def _leaders(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``customer_name, _bucket`` and the most frequent value so far of each column (ties: the smallest).

    Lines are counted by customer, value and bucket first, so the windows see one
    row for each: a customer has as many as it has buckets and segments or
    markets, however many its lines.
    """
    counts = _pairs(lines, columns).groupBy("customer_name", "_column", "_value", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    of_value = Window.partitionBy("customer_name", "_column", "_value").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    seen = counts.withColumn("_seen", F.sum("_n").over(of_value))
    # running counts only grow, so the best row up to a bucket names the leader
    so_far = Window.partitionBy("customer_name").orderBy("_bucket").rangeBetween(Window.unboundedPreceding, 0)
    best = [F.min(F.when(F.col("_column") == c, F.struct((-F.col("_seen")).alias("n"), F.col("_value").alias("v")))).over(so_far).alias(c) for c in columns]
    ranked = seen.select("customer_name", "_bucket", *best)
    return ranked.groupBy("customer_name", "_bucket").agg(*(F.min(f"{c}.v").alias(c) for c in columns))


def bucket_totals(sales: DataFrame, cutoffs: DataFrame, spec: FeatureSpec = SCRIPT_FEATURES) -> DataFrame:
    """Running totals per customer and bucket, and the date of the customer's next order after it."""
    lines = with_bucket(conform(sales), cutoffs)
    keys = ["customer_name", "_bucket"]
    distinct = {f: c for f, (c, default) in _distincts(sales.columns, spec).items() if default is None}
    modes = [c for c in ("segment", "market") if c in sales.columns]
    sums = lines.groupBy(*keys).agg(
        F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"),
        *(exact_sum(F.col(c), as_double=False).alias(n) for c, n in _SUMS.items()),
        *(F.struct(F.max(F.abs(c)).alias("most"), F.sum(c).alias("total")).alias(f"{n}_wide") for c, n in _SUMS.items()),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantidade_itens"),
        F.count("discount").alias("_n_discount"),
        F.count("margem_lucro").alias("_n_margin"),
    )
    out = sums.join(_new_values(lines, distinct), keys, "left")
    if modes:
        out = out.join(_leaders(lines, modes), keys, "left")
    running = Window.partitionBy("customer_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("customer_name").orderBy("_bucket")
    return out.select(
        *keys,
        F.max("_last").over(running).alias("_last"),
        F.min("_first").over(running).alias("_first"),
        *(
            F.when(F.max(f"{n}_wide.most").over(running) >= WIDE, F.sum(f"{n}_wide.total").over(running))
            .otherwise(F.sum(n).over(running).cast("double"))
            .alias(n)
            for n in _SUMS.values()
        ),
        *(F.sum(n).over(running).alias(n) for n in ("quantidade_itens", "_n_discount", "_n_margin")),
        *(F.sum(F.coalesce(f, F.lit(0))).over(running).alias(f) for f in distinct),
        *(F.last(c, ignorenulls=True).over(running).alias(c) for c in modes),
        F.lead("_bucket").over(order).alias("_next_bucket"),
        F.lead("_first").over(order).alias("_next_order"),
    )


_SUMS = {"sales": "_sales", "profit": "_profit", "discount": "_discount", "margem_lucro": "_margin"}


def at_cutoffs(totals: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """One row per customer and cutoff with history: the totals of the customer's last bucket up to it."""
    numbered = cutoffs.select("cutoff", "horizon_days").distinct().select(
        "cutoff", "horizon_days", F.row_number().over(Window.orderBy("cutoff")).alias("_number")
    )
    count = numbered.agg(F.count(F.lit(1)).cast("int").alias("_cutoffs"))
    spread = totals.crossJoin(F.broadcast(count)).filter(F.col("_bucket") <= F.col("_cutoffs"))
    until = F.least(F.coalesce(F.col("_next_bucket") - 1, F.col("_cutoffs")), F.col("_cutoffs"))
    return spread.withColumn("_number", F.explode(F.sequence("_bucket", until))).join(numbered, "_number")


def _features_at(rows: DataFrame, columns: Sequence[str], spec: FeatureSpec, more: Sequence[Column] = ()) -> DataFrame:
    constants = {f: F.lit(d).cast("long") for f, (_, d) in _distincts(columns, spec).items() if d is not None}
    for column, default in (("segment", spec.default_segment), ("market", spec.default_market)):
        constants[column] = F.coalesce(column, F.lit(default)) if column in columns else F.lit(default)
    return _finish(_means(rows.withColumns(constants)), F.col("cutoff"), spec, [F.col("cutoff"), *more])


def customer_features_asof(
    sales: DataFrame, cutoffs: DataFrame, spec: FeatureSpec = SCRIPT_FEATURES
) -> DataFrame:
    """Features of every customer with history on or before each cutoff.

    Output: ``cutoff`` (DATE) followed by the feature columns; one row per
    ``(cutoff, customer_name)``; a cutoff with no history yields no rows.
    """
    if "horizon_days" not in cutoffs.columns:
        cutoffs = cutoffs.withColumn("horizon_days", F.lit(0))
    return _features_at(at_cutoffs(bucket_totals(sales, cutoffs, spec), cutoffs), sales.columns, spec)


def customer_features_current(sales: DataFrame, spec: FeatureSpec = SCRIPT_FEATURES) -> DataFrame:
    """Features on the whole history, recency measured from the latest order date."""
    dated = with_order_date(sales)
    sales = conform(sales)
    features = _distincts(sales.columns, spec)
    distinct = {f: c for f, (c, default) in features.items() if default is None}
    agg = _means(sales.groupBy("customer_name").agg(*_aggregates()))
    agg = agg.join(_value_counts(sales, distinct), "customer_name", "left").withColumns(
        {f: F.coalesce(f, F.lit(0)) if f in distinct else F.lit(default).cast("long") for f, (_, default) in features.items()}
    )
    agg = _with_modes(agg, sales, ["customer_name"], spec)
    ref = dated.agg(F.max("order_date").alias("_ref"))
    return _finish(agg.crossJoin(F.broadcast(ref)), F.col("_ref"), spec, [])


def customer_mode(sales: DataFrame, spec: FeatureSpec = SCRIPT_FEATURES) -> DataFrame:
    """Most frequent segment and market per customer; ties go to the smallest value."""
    sales = conform(sales)
    customers = sales.select("customer_name").distinct()
    return _with_modes(customers, sales, ["customer_name"], spec).select("customer_name", "segment", "market")


def sales_profile(sales: DataFrame) -> DataFrame:
    """Row count, distinct customers and the order-date range, in one aggregate."""
    sales = sales.withColumn("order_date", F.to_date("order_date"))
    return sales.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct("customer_name").alias("clientes_unicos"),
        F.date_format(F.min("order_date"), "yyyy-MM-dd").alias("data_inicial"),
        F.date_format(F.max("order_date"), "yyyy-MM-dd").alias("data_final"),
    )


def history_asof(sales: DataFrame, cutoff: str | dt.date) -> DataFrame:
    """Lines on or before ``cutoff`` (inclusive)."""
    sales = with_order_date(sales)
    return sales.filter(F.col("order_date") <= F.lit(cutoff).cast("date"))
