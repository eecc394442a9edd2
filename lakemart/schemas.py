"""Explicit schemas: no source is read with schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import SALES_COLUMNS

# Raw order lines: every column a nullable string (header-bound, by name).
SALES_RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SALES_COLUMNS])

# Product catalogue shipped with the reference data (no code consumes it).
PRODUCT_CATALOGUE_SCHEMA = T.StructType([
    T.StructField("sku", T.StringType(), True),
    T.StructField("descricao", T.StringType(), True),
    T.StructField("categoria", T.StringType(), True),
    T.StructField("marca", T.StringType(), True),
    T.StructField("nota_olfativa", T.StringType(), True),
    T.StructField("preco_tabela", T.DecimalType(10, 2), True),
    T.StructField("custo_unitario", T.DecimalType(10, 2), True),
    T.StructField("unidade", T.StringType(), True),
    T.StructField("ativo", T.StringType(), True),
    T.StructField("data_lancamento", T.DateType(), True),
])

# Salespeople shipped with the reference data (no code consumes it).
SALESPEOPLE_SCHEMA = T.StructType([
    T.StructField("vendedor_id", T.IntegerType(), True),
    T.StructField("nome", T.StringType(), True),
    T.StructField("regiao", T.StringType(), True),
    T.StructField("uf", T.StringType(), True),
    T.StructField("data_admissao", T.DateType(), True),
    T.StructField("data_desligamento", T.DateType(), True),
    T.StructField("meta_mensal", T.IntegerType(), True),
])

CUTOFF_SCHEMA = T.StructType([
    T.StructField("cutoff", T.DateType(), False),
    T.StructField("horizon_days", T.IntegerType(), False),
])

# The exported ranking, in the order of ``RANKING_EXPORT_COLUMNS``.
RANKING_SCHEMA = T.StructType([
    T.StructField("ranking", T.LongType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("propensity_score", T.DoubleType(), True),
    T.StructField("faixa_propensao", T.StringType(), True),
    T.StructField("percentil_score", T.IntegerType(), True),
    T.StructField("recencia_dias", T.LongType(), True),
    T.StructField("frequencia_pedidos", T.LongType(), True),
    T.StructField("valor_total_gasto", T.DoubleType(), True),
    T.StructField("ticket_medio", T.DoubleType(), True),
    T.StructField("data_ultima_compra", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("market", T.StringType(), True),
])
