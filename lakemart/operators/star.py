"""Silver layer: the cleaned view, four dimensions and the sales fact.

Every builder returns the dataset *before* its drop rules; ``plans.medallion``
applies and counts the rules. Dimensions are ``distinct`` over the whole
projected tuple, not over the key, exactly as the published tables are: a
product id with two names gives two dimension rows and fans out every join on
it. ``dim_key_report`` makes that visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DIM_COLUMNS, DIM_KEYS, FACT_COLUMNS, SALES_ATTRIBUTES, SALES_KEY
from ..functions.cleaning import SALES_CLEANING, clean_columns
from .dedup import dedup_by_key

def sales_cleaned(bronze: DataFrame, specs=SALES_CLEANING) -> DataFrame:
    """De-duplicate on ``(order_id, product_id)``, type the numbers, stamp the time.

    The surviving duplicate is the smallest row over the raw attributes (in
    ``SALES_ATTRIBUTES`` order, NULLs first), taken on the raw strings, before
    cleaning, as the published view does.
    """
    order = [c for c in SALES_ATTRIBUTES if c in bronze.columns]
    deduped = dedup_by_key(bronze, SALES_KEY, order)
    return clean_columns(deduped, specs).withColumn("_updated_at", F.current_timestamp())


def dimension(cleaned: DataFrame, name: str) -> DataFrame:
    return cleaned.select(*DIM_COLUMNS[name]).distinct()


def dim_produto(cleaned: DataFrame) -> DataFrame:
    return dimension(cleaned, "dim_produto")


def dim_cliente(cleaned: DataFrame) -> DataFrame:
    return dimension(cleaned, "dim_cliente")


def dim_localizacao(cleaned: DataFrame) -> DataFrame:
    return dimension(cleaned, "dim_localizacao")


def dim_modo_envio(cleaned: DataFrame) -> DataFrame:
    return dimension(cleaned, "dim_modo_envio")


def ft_vendas(cleaned: DataFrame, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    return cleaned.select(*columns)


def dim_key_report(dim: DataFrame, name: str) -> DataFrame:
    """Rows vs distinct keys of a dimension; ``duplicated_keys`` > 0 means fan-out."""
    keys = list(DIM_KEYS[name])
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(name).alias("dimension"),
        F.sum("n").alias("dim_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.max("n").alias("max_rows_per_key"),
    )
