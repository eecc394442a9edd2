"""Gold layer: the three KPI marts over the sales fact and one dimension each.

Each mart is a fact ⋈ dimension inner join followed by a group-by. The fact is
first aggregated down to the join key (plus the order id where a distinct
order count is needed), map-side combined, so the join shuffles one row per
key and map task instead of one row per order line, and a hot key cannot
reach the join as millions of rows. Sums are distributive and every
pre-aggregated row meets the same dimension rows its lines would have met, so
the dimension fan-out of the published marts is preserved exactly. Averages
are carried as (sum, count).

Money columns of the fact carry 2 decimals and the margin 4 (the cleaning
rounds them), so they are summed exactly in those units (``scaled_sum``) and
turned back into doubles at the end: totals do not depend on how partitions
were combined.

Which join strategy runs is left to AQE: it broadcasts a dimension only when
its measured runtime size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import scaled_sum, units_to_double


#: What each mart reads of the fact, and the fact's columns that its lines are first added up by.
MART_READS = {
    "vendas_por_categoria": ("product_id", "sales", "profit", "quantity", "margem_lucro"),
    "desempenho_regional": ("country", "state", "order_id", "sales", "profit", "shipping_cost"),
    "metrica_clientes": ("customer_name", "order_id", "sales", "profit"),
}
MART_GROUPS = {
    "vendas_por_categoria": ("product_id",),
    "desempenho_regional": ("country", "state", "order_id"),
    "metrica_clientes": ("customer_name", "order_id"),
}


def totals(columns: Iterable[str]) -> list[Column]:
    """Exact sums of the fact's measures, those among ``columns``."""
    made = {
        "sales": (F.sum("sales").alias("s_sales"),),
        "profit": (scaled_sum(F.col("profit"), 2).alias("s_profit"),),
        "shipping_cost": (scaled_sum(F.col("shipping_cost"), 2).alias("s_shipping"),),
        "quantity": (F.sum("quantity").alias("s_quantity"),),
        "margem_lucro": (scaled_sum(F.col("margem_lucro"), 4).alias("s_margin"), F.count("margem_lucro").alias("n_margin")),
    }
    return [c for name in columns for c in made.get(name, ())]


def pre_aggregated(ft: DataFrame, mart: str) -> DataFrame:
    """The fact's lines added up as far as the mart's join allows."""
    return ft.groupBy(*MART_GROUPS[mart]).agg(*totals(MART_READS[mart]))


def vendas_por_categoria(ft: DataFrame, dim_prod: DataFrame) -> DataFrame:
    return category_kpis(pre_aggregated(ft, "vendas_por_categoria"), dim_prod)


def desempenho_regional(ft: DataFrame, dim_loc: DataFrame) -> DataFrame:
    return regional_kpis(pre_aggregated(ft, "desempenho_regional"), dim_loc)


def metrica_clientes(ft: DataFrame, dim_cli: DataFrame) -> DataFrame:
    return segment_kpis(pre_aggregated(ft, "metrica_clientes"), dim_cli)


def category_kpis(per_product: DataFrame, dim_prod: DataFrame) -> DataFrame:
    return per_product.join(dim_prod, "product_id", "inner").groupBy("category", "sub_category").agg(
        F.sum("s_sales").alias("faturamento_total"),
        units_to_double(F.sum("s_profit"), 2).alias("lucro_total"),
        F.sum("s_quantity").alias("qtd_itens_vendidos"),
        F.round(F.try_divide(units_to_double(F.sum("s_margin"), 4), F.sum("n_margin")), 4).alias("margem_media"),
    )


def regional_kpis(per_order: DataFrame, dim_loc: DataFrame) -> DataFrame:
    return per_order.join(dim_loc, ["country", "state"], "inner").groupBy("market", "region", "country").agg(
        F.sum("s_sales").alias("faturamento_total"),
        units_to_double(F.sum("s_profit"), 2).alias("lucro_total"),
        units_to_double(F.sum("s_shipping"), 2).alias("custo_frete_total"),
        F.count_distinct("order_id").alias("total_pedidos"),
    )


def segment_kpis(per_order: DataFrame, dim_cli: DataFrame) -> DataFrame:
    return per_order.join(dim_cli, "customer_name", "inner").groupBy("segment").agg(
        F.count_distinct("customer_name").alias("total_clientes"),
        F.sum("s_sales").alias("faturamento_total"),
        units_to_double(F.sum("s_profit"), 2).alias("lucro_total"),
        F.round(
            F.try_divide(F.sum("s_sales"), F.count_distinct("order_id")), 2
        ).alias("ticket_medio_por_pedido"),
    )


KPIS = {"vendas_por_categoria": category_kpis, "desempenho_regional": regional_kpis, "metrica_clientes": segment_kpis}

MART_KEYS = {
    "vendas_por_categoria": ("category", "sub_category"),
    "desempenho_regional": ("market", "region", "country"),
    "metrica_clientes": ("segment",),
}


def by_revenue(df: DataFrame, *keys: str) -> DataFrame:
    """Presentation order of a mart: revenue descending, then the keys."""
    return df.orderBy(F.col("faturamento_total").desc_nulls_last(), *[F.col(k).asc() for k in keys])
