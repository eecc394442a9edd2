"""Names, rules and parameters of the retail sales lakehouse.

Table and column names are the published contract of the datasets and are
kept as they are (Portuguese). Everything a run may want to change is a
field of a frozen dataclass so that a caller can ``dataclasses.replace`` it.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference's for right results.
# ---------------------------------------------------------------------------

# Raw sales columns, in the order used to pick the surviving duplicate.
SALES_KEY = ("order_id", "product_id")
SALES_ATTRIBUTES = (
    "order_date", "ship_date", "customer_name", "segment", "country", "state",
    "market", "region", "category", "sub_category", "product_name", "ship_mode",
    "order_priority", "sales", "quantity", "discount", "profit", "shipping_cost",
    "margem_lucro",
)
SALES_COLUMNS = SALES_KEY + SALES_ATTRIBUTES

# Characters removed before numeric casts (quotes and whitespace).
STRIP_PATTERN = r'["\s]'

# Data-quality rules: (dataset, rule name, SQL predicate, action).
QUALITY_RULES = (
    ("sales_raw", "valid_source_file_metadata", "_source_file IS NOT NULL", "warn"),
    ("dim_produto", "valid_product_id", "product_id IS NOT NULL", "drop"),
    ("dim_produto", "valid_product_name", "product_name IS NOT NULL", "warn"),
    ("dim_cliente", "valid_customer_name", "customer_name IS NOT NULL", "drop"),
    ("dim_cliente", "valid_segment", "segment IS NOT NULL", "warn"),
    ("dim_localizacao", "valid_location", "country IS NOT NULL AND state IS NOT NULL", "drop"),
    ("dim_modo_envio", "valid_ship_mode", "ship_mode IS NOT NULL", "drop"),
    ("ft_vendas", "valid_primary_keys", "order_id IS NOT NULL AND product_id IS NOT NULL", "drop"),
    ("ft_vendas", "valid_positive_sales", "sales > 0", "drop"),
    ("ft_vendas", "valid_positive_quantity", "quantity > 0", "drop"),
    ("ft_vendas", "valid_discount_range", "discount >= 0 AND discount <= 1.0", "warn"),
    ("ft_vendas", "valid_shipping_cost", "shipping_cost >= 0", "warn"),
    ("ft_vendas", "valid_dates_chronology", "order_date <= ship_date", "warn"),
    ("vendas_por_categoria", "valid_category_revenue", "faturamento_total > 0", "warn"),
    ("vendas_por_categoria", "valid_category_items", "qtd_itens_vendidos > 0", "warn"),
    ("desempenho_regional", "valid_regional_revenue", "faturamento_total > 0", "warn"),
    ("desempenho_regional", "valid_orders_count", "total_pedidos > 0", "warn"),
    ("metrica_clientes", "valid_segment_revenue", "faturamento_total > 0", "warn"),
    ("metrica_clientes", "valid_ticket_medio", "ticket_medio_por_pedido > 0", "warn"),
)

# Training cutoffs of the standalone script (90-day label window) and the
# single cutoff of the notebook (180-day window).
SCRIPT_CUTOFFS = ("2012-06-30", "2012-12-31", "2013-06-30", "2013-12-31")
SCRIPT_HORIZON_DAYS = 90
NOTEBOOK_CUTOFF = "2014-06-30"
NOTEBOOK_HORIZON_DAYS = 180

# Score bands: score >= 0.70 high, >= 0.40 medium, else low.
BAND_HIGH = 0.70
BAND_MEDIUM = 0.40
SCRIPT_BAND_LABELS = (
    "Alta Propensão (Foco em Conversão)",
    "Média Propensão (Foco em Nutrição)",
    "Baixa Propensão (Foco em Reativação)",
)
NOTEBOOK_BAND_LABELS = (
    "1. Alta Propensão (Conversão Imediata / Oferta Direta)",
    "2. Média Propensão (Nutrição / Engajamento)",
    "3. Baixa Propensão (Reativação / Churn Risk)",
)

# Mode fallbacks when a customer has no segment / market value.
SCRIPT_DEFAULT_SEGMENT = "Unknown"
SCRIPT_DEFAULT_MARKET = "Unknown"
NOTEBOOK_DEFAULT_SEGMENT = "Consumer"
NOTEBOOK_DEFAULT_MARKET = "Global"

# Model features.
SCRIPT_NUMERIC_FEATURES = (
    "recencia_dias", "frequencia_pedidos", "valor_total_gasto", "quantidade_itens",
    "ticket_medio", "lucro_total", "desconto_medio", "margem_media",
    "qtd_categorias_distintas", "qtd_subcategorias_distintas", "qtd_produtos_distintos",
    "tempo_relacionamento_dias",
)
NOTEBOOK_NUMERIC_FEATURES = (
    "recencia_dias", "frequencia_pedidos", "valor_total_gasto", "quantidade_itens",
    "ticket_medio", "lucro_total", "desconto_medio", "margem_media",
    "qtd_categorias_distintas", "tempo_relacionamento_dias",
)
CATEGORICAL_FEATURES = ("segment", "market")
LABEL = "target_comprou"

# Gradient-boosted trees: 150 trees, depth 4, learning rate 0.05, row and
# column sampling 0.8, seed 42; 20 % stratified hold-out; 5 folds.
GBT_TREES = 150
GBT_DEPTH = 4
GBT_STEP = 0.05
GBT_ROW_SAMPLE = 0.8
GBT_COLUMN_SAMPLE = 0.8
SEED = 42
TEST_FRACTION = 0.20
CV_FOLDS = 5

# Columns of the dimensions (and the keys they are joined on) and of the sales fact, as published.
DIM_COLUMNS = {
    "dim_produto": ("product_id", "product_name", "category", "sub_category"),
    "dim_cliente": ("customer_name", "segment"),
    "dim_localizacao": ("country", "state", "region", "market"),
    "dim_modo_envio": ("ship_mode", "order_priority"),
}

DIM_KEYS = {
    "dim_produto": ("product_id",),
    "dim_cliente": ("customer_name",),
    "dim_localizacao": ("country", "state"),
    "dim_modo_envio": ("ship_mode",),
}

FACT_COLUMNS = (
    "order_id", "order_date", "ship_date", "customer_name", "product_id", "country",
    "state", "ship_mode", "sales", "quantity", "discount", "profit", "shipping_cost",
    "margem_lucro", "_updated_at",
)

# Export columns of the scored ranking (script).
RANKING_EXPORT_COLUMNS = (
    "ranking", "customer_name", "propensity_score", "faixa_propensao", "percentil_score",
    "recencia_dias", "frequencia_pedidos", "valor_total_gasto", "ticket_medio",
    "data_ultima_compra", "segment", "market",
)

# ---------------------------------------------------------------------------
# Parameter records
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSpec:
    """Which customer features to build and how to fill gaps.

    ``extended`` adds the sub-category and product distinct counts of the
    standalone script; the notebook variant leaves them out.
    """

    extended: bool = True
    default_segment: str = SCRIPT_DEFAULT_SEGMENT
    default_market: str = SCRIPT_DEFAULT_MARKET
    default_category_count: int = 1


SCRIPT_FEATURES = FeatureSpec()
NOTEBOOK_FEATURES = FeatureSpec(
    extended=False,
    default_segment=NOTEBOOK_DEFAULT_SEGMENT,
    default_market=NOTEBOOK_DEFAULT_MARKET,
)


@dataclass(frozen=True)
class BandSpec:
    column: str = "faixa_propensao"
    high: float = BAND_HIGH
    medium: float = BAND_MEDIUM
    labels: tuple[str, str, str] = SCRIPT_BAND_LABELS


SCRIPT_BANDS = BandSpec()
NOTEBOOK_BANDS = BandSpec(column="estrategia_crm", labels=NOTEBOOK_BAND_LABELS)


@dataclass(frozen=True)
class ModelSpec:
    numeric: tuple[str, ...] = SCRIPT_NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    label: str = LABEL
    trees: int = GBT_TREES
    depth: int = GBT_DEPTH
    step: float = GBT_STEP
    row_sample: float = GBT_ROW_SAMPLE
    column_sample: float = GBT_COLUMN_SAMPLE
    seed: int = SEED
    test_fraction: float = TEST_FRACTION
    folds: int = CV_FOLDS
    balance_classes: bool = True
    #: ``binned``: trees over quantile bins, all folds grown together; ``mllib``: GBTClassifier
    learner: str = "binned"


@dataclass(frozen=True)
class Layers:
    """Where the medallion datasets are written (``catalog.schema`` prefixes)."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    table_format: str = "parquet"
