"""DuckDB SQL that recomputes each registered query independently.

The tables ``lineitem orders customer nation region part`` are views. Dialect
notes (DuckDB vs Spark): ``regexp_replace`` needs the ``'g'`` flag to replace
every match; ``CAST(double AS INTEGER)`` rounds, so truncation is spelled
``trunc``; ``sum`` of integers is HUGEINT, so it is cast back to BIGINT;
``datediff`` takes the unit first; Spark's HALF_UP ``round`` of a double
rounds the shortest decimal rendering, spelled here as a DECIMAL round.
"""

from __future__ import annotations

SALES_ATTRS = (
    "order_date", "ship_date", "customer_name", "segment", "country", "state",
    "market", "region", "category", "sub_category", "product_name", "ship_mode",
    "order_priority", "sales", "quantity", "discount", "profit", "shipping_cost",
    "margem_lucro",
)
RAW_COLS = ("order_id", "product_id") + SALES_ATTRS

PRICE = "CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
DISC = "CAST(l.l_discount AS DECIMAL(4,2))"


def spark_round(x: str, s: int) -> str:
    """Spark ``round(double, s)``: HALF_UP on the shortest decimal rendering."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), {s}) AS DOUBLE)"


def np_round(x: str, s: int) -> str:
    """Ties-to-even on the scaled binary value (rint(x * 10^s) / 10^s)."""
    f = float(10**s)
    return f"(round_even(({x}) * {f}, 0) / {f})"


def units_sum(x: str, s: int) -> str:
    """Exact sum of a double column already rounded to ``s`` decimals, back as double."""
    f = float(10**s)
    return f"(CAST(sum(CAST(round({x} * {f}) AS DECIMAL(38,0))) AS DOUBLE) / {f})"


RAW_SALES = f"""
raw_sales AS (
  SELECT
    CASE WHEN l.l_orderkey % 499 = 0 THEN NULL ELSE 'O' || CAST(l.l_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN l.l_partkey % 997 = 0 THEN NULL ELSE 'P' || CAST(l.l_partkey AS VARCHAR) END AS product_id,
    CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
    CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS ship_date,
    CASE WHEN l.l_orderkey % 1499 = 0 THEN 'NA' ELSE c.c_name END AS customer_name,
    c.c_mktsegment AS segment,
    n.n_name AS country,
    n.n_name || '-' || CAST(c.c_custkey % 4 AS VARCHAR) AS state,
    r.r_name AS market,
    r.r_name || '-' || CAST(n.n_nationkey % 2 AS VARCHAR) AS region,
    p.p_type AS category,
    p.p_brand AS sub_category,
    CASE WHEN l.l_suppkey % 20 = 0 THEN p.p_name || ' II' ELSE p.p_name END AS product_name,
    l.l_linestatus AS ship_mode,
    o.o_orderpriority AS order_priority,
    CASE WHEN l.l_orderkey % 101 = 0 THEN '1,234'
         WHEN l.l_orderkey % 7 = 0 THEN '"' || {PRICE} || ' "'
         WHEN l.l_orderkey % 53 = 0 THEN '-' || {PRICE}
         WHEN l.l_orderkey % 103 = 0 THEN {PRICE} || '123457'
         ELSE {PRICE} END AS sales,
    CASE WHEN l.l_orderkey % 89 = 0 THEN '0'
         WHEN l.l_orderkey % 97 = 0 THEN 'n/a'
         WHEN l.l_orderkey % 83 = 0 THEN 'NaN'
         ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN l.l_orderkey % 211 = 0 THEN '1.50'
         WHEN l.l_linenumber % 2 = 0 THEN replace(CAST({DISC} AS VARCHAR), '.', ',')
         ELSE CAST({DISC} AS VARCHAR) END AS discount,
    CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (0.15 - {DISC}) AS DECIMAL(14,2)) AS VARCHAR) AS profit,
    CASE WHEN l.l_orderkey % 307 = 0 THEN '-1.00'
         ELSE CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS VARCHAR) END AS shipping_cost,
    CASE WHEN l.l_orderkey % 2 = 0 THEN replace(CAST(0.15 - {DISC} AS VARCHAR), '.', ',')
         ELSE CAST(0.15 - {DISC} AS VARCHAR) END AS margem_lucro,
    'lineitem.parquet' AS _source_file
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in SALES_ATTRS + ("_source_file",))

DEDUP = f"""
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY {_ORDER}) AS rn
    FROM raw_sales
  ) WHERE rn = 1
)"""


def _strip(c: str) -> str:
    return f"""regexp_replace({c}, '["\\s]', '', 'g')"""


def _cleaned_select(src: str) -> str:
    keep = [c for c in RAW_COLS if c not in ("sales", "quantity", "discount", "margem_lucro", "profit", "shipping_cost")]
    cols = ",\n    ".join(keep)
    return f"""
  SELECT
    {cols},
    try_cast(trunc(try_cast({_strip('sales')} AS DOUBLE)) AS INTEGER) AS sales,
    try_cast(trunc(try_cast({_strip('quantity')} AS DOUBLE)) AS INTEGER) AS quantity,
    try_cast(replace({_strip('discount')}, ',', '.') AS DOUBLE) AS discount,
    {spark_round("try_cast(replace(" + _strip('margem_lucro') + ", ',', '.') AS DOUBLE)", 4)} AS margem_lucro,
    {spark_round("try_cast(profit AS DOUBLE)", 2)} AS profit,
    {spark_round("try_cast(shipping_cost AS DOUBLE)", 2)} AS shipping_cost,
    _source_file
  FROM {src}"""


CLEANED = f"""
cleaned_raw AS ({_cleaned_select('dedup')}
),
cleaned AS (
  SELECT {", ".join(RAW_COLS)}, _source_file FROM cleaned_raw
)"""

DIMS = """
dim_produto_pre AS (SELECT DISTINCT product_id, product_name, category, sub_category FROM cleaned),
dim_produto AS (SELECT * FROM dim_produto_pre WHERE product_id IS NOT NULL),
dim_cliente_pre AS (SELECT DISTINCT customer_name, segment FROM cleaned),
dim_cliente AS (SELECT * FROM dim_cliente_pre WHERE customer_name IS NOT NULL),
dim_localizacao_pre AS (SELECT DISTINCT country, state, region, market FROM cleaned),
dim_localizacao AS (SELECT * FROM dim_localizacao_pre WHERE country IS NOT NULL AND state IS NOT NULL),
dim_modo_envio_pre AS (SELECT DISTINCT ship_mode, order_priority FROM cleaned),
dim_modo_envio AS (SELECT * FROM dim_modo_envio_pre WHERE ship_mode IS NOT NULL),
ft_pre AS (
  SELECT order_id, order_date, ship_date, customer_name, product_id, country, state, ship_mode,
         sales, quantity, discount, profit, shipping_cost, margem_lucro
  FROM cleaned
),
ft_vendas AS (
  SELECT * FROM ft_pre
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND sales > 0 AND quantity > 0
)"""

MARTS = f"""
vendas_por_categoria AS (
  SELECT category, sub_category,
         CAST(sum(f.sales) AS BIGINT) AS faturamento_total,
         {units_sum("f.profit", 2)} AS lucro_total,
         CAST(sum(f.quantity) AS BIGINT) AS qtd_itens_vendidos,
         {spark_round(units_sum("f.margem_lucro", 4) + " / count(f.margem_lucro)", 4)} AS margem_media
  FROM ft_vendas f JOIN dim_produto d ON f.product_id = d.product_id
  GROUP BY category, sub_category
),
desempenho_regional AS (
  SELECT market, region, d.country,
         CAST(sum(f.sales) AS BIGINT) AS faturamento_total,
         {units_sum("f.profit", 2)} AS lucro_total,
         {units_sum("f.shipping_cost", 2)} AS custo_frete_total,
         count(DISTINCT f.order_id) AS total_pedidos
  FROM ft_vendas f JOIN dim_localizacao d ON f.country = d.country AND f.state = d.state
  GROUP BY market, region, d.country
),
metrica_clientes AS (
  SELECT segment,
         count(DISTINCT f.customer_name) AS total_clientes,
         CAST(sum(f.sales) AS BIGINT) AS faturamento_total,
         {units_sum("f.profit", 2)} AS lucro_total,
         {spark_round("CAST(sum(f.sales) AS DOUBLE) / count(DISTINCT f.order_id)", 2)} AS ticket_medio_por_pedido
  FROM ft_vendas f JOIN dim_cliente d ON f.customer_name = d.customer_name
  GROUP BY segment
)"""

SILVER = f"WITH {RAW_SALES},{DEDUP},{CLEANED},{DIMS}"
GOLD = f"{SILVER},{MARTS}"

# Texts that the script's reader takes for missing values.
_MISSING = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def _present(c: str, as_: str = "") -> str:
    return f"CASE WHEN {c} NOT IN ({_MISSING}) THEN {c} END{f' AS {as_}' if as_ else ''}"


def dec_sum(c: str) -> str:
    """Sum of the numbers as they are written, in decimals."""
    return f"CAST(sum({c}_dec) AS DOUBLE)"


def written_sum(c: str) -> str:
    """Sum of doubles by their shortest decimal form."""
    return f"CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(30,10))) AS DOUBLE)"


# Standalone-script input: tolerant numeric typing, required fields present.
SCRIPT_SALES = f"""
script_sales AS (
  SELECT order_id, product_id, CAST(order_date AS DATE) AS order_date, ship_date, customer_name, segment,
         country, state, market, region, category, sub_category, product_name, ship_mode, order_priority,
         try_cast(sales AS DOUBLE) AS sales, try_cast(quantity AS DOUBLE) AS quantity,
         try_cast(discount AS DOUBLE) AS discount, try_cast(profit AS DOUBLE) AS profit,
         shipping_cost, try_cast(margem_lucro AS DOUBLE) AS margem_lucro,
         try_cast(sales AS DECIMAL(30,10)) AS sales_dec, try_cast(discount AS DECIMAL(30,10)) AS discount_dec,
         try_cast(profit AS DECIMAL(30,10)) AS profit_dec, try_cast(margem_lucro AS DECIMAL(30,10)) AS margem_lucro_dec
  FROM (SELECT {", ".join(_present(c, c) for c in RAW_COLS)} FROM raw_sales)
  WHERE order_id IS NOT NULL AND customer_name IS NOT NULL AND order_date IS NOT NULL
    AND try_cast(sales AS DOUBLE) IS NOT NULL
)"""

CUTOFFS = """
cutoffs AS (
  SELECT CAST(c AS DATE) AS cutoff, 90 AS horizon_days
  FROM (VALUES ('1996-06-30'), ('1996-12-31'), ('1997-06-30'), ('1997-12-31')) t(c)
)"""


def features_cte(name: str, sales: str, extended: bool, default_seg: str, default_mkt: str,
                 with_cutoffs: bool, integer_quantity: bool = False) -> str:
    """Per-customer features; ``with_cutoffs`` pairs lines with each cutoff they precede."""
    if with_cutoffs:
        hist = f"SELECT s.*, k.cutoff AS ref FROM {sales} s JOIN cutoffs k ON s.order_date <= k.cutoff"
        grp = "ref, customer_name"
        ref_expr = "ref"
        lead = "CAST(a.ref AS VARCHAR) AS cutoff, "
        src_ref = ""
    else:
        hist = f"SELECT s.*, (SELECT max(order_date) FROM {sales}) AS ref FROM {sales} s"
        grp = "ref, customer_name"
        ref_expr = "ref"
        lead = ""
        src_ref = ""
    ext_cols = ""
    ext_out = ""
    if extended:
        ext_cols = (", count(DISTINCT sub_category) AS qtd_subcategorias_distintas,"
                    " count(DISTINCT product_id) AS qtd_produtos_distintos")
        ext_out = " qtd_subcategorias_distintas, qtd_produtos_distintos,"
    mode = lambda col, dflt: f"""
{name}_{col}_mode AS (
  SELECT ref, customer_name, {col} AS mode_value FROM (
    SELECT ref, customer_name, {col},
           row_number() OVER (PARTITION BY ref, customer_name ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM {name}_hist WHERE {col} IS NOT NULL GROUP BY ref, customer_name, {col}
  ) WHERE rn = 1
)"""
    return f"""
{name}_hist AS ({hist} WHERE s.customer_name IS NOT NULL){src_ref},
{mode('segment', default_seg)},
{mode('market', default_mkt)},
{name}_agg AS (
  SELECT {grp},
         max(order_date) AS last_d, min(order_date) AS first_d,
         count(DISTINCT order_id) AS frequencia_pedidos,
         coalesce({dec_sum("sales")}, 0.0) AS value,
         {"CAST(coalesce(sum(quantity), 0) AS BIGINT)" if integer_quantity else "coalesce(sum(quantity), 0)"} AS quantidade_itens,
         coalesce({dec_sum("profit")}, 0.0) AS profit_sum,
         {dec_sum("discount")} / count(discount) AS disc,
         {dec_sum("margem_lucro")} / count(margem_lucro) AS margin,
         count(DISTINCT category) AS qtd_categorias_distintas{ext_cols}
  FROM {name}_hist GROUP BY {grp}
),
{name} AS (
  SELECT {lead}a.customer_name,
         coalesce(sm.mode_value, '{default_seg}') AS segment,
         coalesce(mm.mode_value, '{default_mkt}') AS market,
         datediff('day', a.last_d, a.{ref_expr}) AS recencia_dias,
         a.frequencia_pedidos,
         {np_round("CAST(a.value AS DOUBLE)", 2)} AS valor_total_gasto,
         a.quantidade_itens,
         {np_round("CASE WHEN a.frequencia_pedidos > 0 THEN CAST(a.value AS DOUBLE) / a.frequencia_pedidos ELSE 0.0 END", 2)} AS ticket_medio,
         {np_round("CAST(a.profit_sum AS DOUBLE)", 2)} AS lucro_total,
         {np_round("a.disc", 4)} AS desconto_medio,
         {np_round("a.margin", 4)} AS margem_media,
         a.qtd_categorias_distintas,{ext_out}
         datediff('day', a.first_d, a.last_d) AS tempo_relacionamento_dias,
         strftime(a.first_d, '%Y-%m-%d') AS data_primeira_compra,
         strftime(a.last_d, '%Y-%m-%d') AS data_ultima_compra
  FROM {name}_agg a
  LEFT JOIN {name}_segment_mode sm ON a.ref = sm.ref AND a.customer_name = sm.customer_name
  LEFT JOIN {name}_market_mode mm ON a.ref = mm.ref AND a.customer_name = mm.customer_name
)"""


BUYERS = """
buyers AS (
  SELECT DISTINCT k.cutoff, s.customer_name
  FROM script_sales s JOIN cutoffs k
    ON s.order_date > k.cutoff AND s.order_date <= k.cutoff + k.horizon_days
  WHERE s.customer_name IS NOT NULL
)"""

SCRIPT_BASE = f"WITH {RAW_SALES},{SCRIPT_SALES},{CUTOFFS}"
FEATS_ASOF = features_cte("feats", "script_sales", True, "Unknown", "Unknown", True)
FEATS_CURRENT = features_cte("feats_now", "script_sales", True, "Unknown", "Unknown", False)

TRAINING = f"""{SCRIPT_BASE},{FEATS_ASOF},{BUYERS},
training AS (
  SELECT f.*, CASE WHEN b.customer_name IS NULL THEN 0 ELSE 1 END AS target_comprou
  FROM feats f LEFT JOIN buyers b
    ON CAST(b.cutoff AS VARCHAR) = f.cutoff AND b.customer_name = f.customer_name
)"""

SCORED = f"""{SCRIPT_BASE},{FEATS_CURRENT},
scores AS (
  SELECT c_name AS customer_name, round(CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 10007.0, 4) AS propensity_score
  FROM customer
),
scored AS (SELECT f.*, s.propensity_score FROM feats_now f JOIN scores s ON f.customer_name = s.customer_name),
edges AS (
  SELECT list_distinct(quantile_cont(propensity_score,
         [{", ".join(repr(i * 0.1) for i in range(11))}])) AS e
  FROM scored
),
banded AS (
  SELECT s.*,
         CASE WHEN len(e) > 1 THEN greatest(1, len(list_filter(e, lambda x: x < s.propensity_score))) END AS percentil_score,
         CASE WHEN s.propensity_score >= 0.70 THEN 'Alta Propensão (Foco em Conversão)'
              WHEN s.propensity_score >= 0.40 THEN 'Média Propensão (Foco em Nutrição)'
              ELSE 'Baixa Propensão (Foco em Reativação)' END AS faixa_propensao,
         CASE WHEN s.propensity_score >= 0.70 THEN '1. Alta Propensão (Conversão Imediata / Oferta Direta)'
              WHEN s.propensity_score >= 0.40 THEN '2. Média Propensão (Nutrição / Engajamento)'
              ELSE '3. Baixa Propensão (Reativação / Churn Risk)' END AS estrategia_crm,
         row_number() OVER (ORDER BY s.propensity_score DESC, s.customer_name ASC) AS ranking
  FROM scored s, edges
)"""

LABELLED = f"""{TRAINING},
labelled AS (
  SELECT t.cutoff, t.customer_name, t.target_comprou AS label,
         round(CAST(c.c_custkey * 7919 % 10007 AS DOUBLE) / 10007.0, 4) AS score
  FROM training t JOIN customer c ON t.customer_name = c.c_name
),
pred AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM labelled),
cm AS (
  SELECT g.label, g.prediction, coalesce(n, 0) AS n
  FROM (SELECT * FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(prediction)) g
  LEFT JOIN (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction) c
    ON g.label = c.label AND g.prediction = c.prediction
)"""

# Enriched input of the notebook path.
ENRICHED = f"""{SILVER},
enriched AS (
  SELECT f.*, dc.segment, dl.region, dl.market, dp.product_name, dp.category, dp.sub_category
  FROM ft_vendas f
  LEFT JOIN dim_cliente dc ON f.customer_name = dc.customer_name
  LEFT JOIN dim_localizacao dl ON f.country = dl.country AND f.state = dl.state
  LEFT JOIN dim_produto dp ON f.product_id = dp.product_id
)"""

_QUALITY_ROWS = [
    ("sales_raw", "valid_source_file_metadata", "warn", "_source_file IS NOT NULL", "raw_sales"),
    ("dim_produto", "valid_product_id", "drop", "product_id IS NOT NULL", "dim_produto_pre"),
    ("dim_produto", "valid_product_name", "warn", "product_name IS NOT NULL", "dim_produto_pre"),
    ("dim_cliente", "valid_customer_name", "drop", "customer_name IS NOT NULL", "dim_cliente_pre"),
    ("dim_cliente", "valid_segment", "warn", "segment IS NOT NULL", "dim_cliente_pre"),
    ("dim_localizacao", "valid_location", "drop", "country IS NOT NULL AND state IS NOT NULL", "dim_localizacao_pre"),
    ("dim_modo_envio", "valid_ship_mode", "drop", "ship_mode IS NOT NULL", "dim_modo_envio_pre"),
    ("ft_vendas", "valid_primary_keys", "drop", "order_id IS NOT NULL AND product_id IS NOT NULL", "ft_pre"),
    ("ft_vendas", "valid_positive_sales", "drop", "sales > 0", "ft_pre"),
    ("ft_vendas", "valid_positive_quantity", "drop", "quantity > 0", "ft_pre"),
    ("ft_vendas", "valid_discount_range", "warn", "discount >= 0 AND discount <= 1.0", "ft_pre"),
    ("ft_vendas", "valid_shipping_cost", "warn", "shipping_cost >= 0", "ft_pre"),
    ("ft_vendas", "valid_dates_chronology", "warn", "order_date <= ship_date", "ft_pre"),
    ("vendas_por_categoria", "valid_category_revenue", "warn", "faturamento_total > 0", "vendas_por_categoria"),
    ("vendas_por_categoria", "valid_category_items", "warn", "qtd_itens_vendidos > 0", "vendas_por_categoria"),
    ("desempenho_regional", "valid_regional_revenue", "warn", "faturamento_total > 0", "desempenho_regional"),
    ("desempenho_regional", "valid_orders_count", "warn", "total_pedidos > 0", "desempenho_regional"),
    ("metrica_clientes", "valid_segment_revenue", "warn", "faturamento_total > 0", "metrica_clientes"),
    ("metrica_clientes", "valid_ticket_medio", "warn", "ticket_medio_por_pedido > 0", "metrica_clientes"),
]


def _quality_sql() -> str:
    parts = []
    for ds, rule, action, pred, src in _QUALITY_ROWS:
        parts.append(
            f"SELECT '{ds}' AS dataset, '{rule}' AS rule, '{action}' AS action, '{pred}' AS predicate, "
            f"count(*) AS total_rows, count(*) FILTER (WHERE coalesce({pred}, false)) AS passed, "
            f"count(*) - count(*) FILTER (WHERE coalesce({pred}, false)) AS failed FROM {src}"
        )
    return f"{GOLD}\n" + "\nUNION ALL\n".join(parts)


def _conformity_sql() -> str:
    sets = [
        ("dim_produto", "dim_produto_pre", "product_id IS NOT NULL"),
        ("dim_cliente", "dim_cliente_pre", "customer_name IS NOT NULL"),
        ("dim_localizacao", "dim_localizacao_pre", "country IS NOT NULL AND state IS NOT NULL"),
        ("dim_modo_envio", "dim_modo_envio_pre", "ship_mode IS NOT NULL"),
        ("ft_vendas", "ft_pre",
         "order_id IS NOT NULL AND product_id IS NOT NULL AND sales > 0 AND quantity > 0"),
    ]
    parts = []
    for ds, src, keep in sets:
        kept = f"count(*) FILTER (WHERE coalesce({keep}, false))"
        parts.append(
            f"SELECT '{ds}' AS dataset, count(*) AS input_rows, {kept} AS kept_rows, "
            f"count(*) - {kept} AS dropped_rows, "
            f"{spark_round(f'{kept} * 100.0 / count(*)', 1)} AS conformity_pct, "
            f"{spark_round(f'(count(*) - {kept}) * 100.0 / count(*)', 1)} AS anomaly_pct FROM {src}"
        )
    return f"{SILVER}\n" + "\nUNION ALL\n".join(parts)


def _dim_key_sql() -> str:
    keys = {
        "dim_produto": "product_id",
        "dim_cliente": "customer_name",
        "dim_localizacao": "country, state",
        "dim_modo_envio": "ship_mode",
    }
    parts = []
    for d, k in keys.items():
        parts.append(
            f"SELECT '{d}' AS dimension, CAST(sum(n) AS BIGINT) AS dim_rows, count(*) AS distinct_keys, "
            f"count(*) FILTER (WHERE n > 1) AS duplicated_keys, max(n) AS max_rows_per_key "
            f"FROM (SELECT {k}, count(*) AS n FROM {d} GROUP BY {k})"
        )
    return f"{SILVER}\n" + "\nUNION ALL\n".join(parts)


_FEATURE_COLS = (
    "customer_name, segment, market, recencia_dias, frequencia_pedidos, valor_total_gasto, quantidade_itens, "
    "ticket_medio, lucro_total, desconto_medio, margem_media, qtd_categorias_distintas, "
    "qtd_subcategorias_distintas, qtd_produtos_distintos, tempo_relacionamento_dias, "
    "data_primeira_compra, data_ultima_compra"
)

# The cleaned figures are doubles: their shortest decimal form is what is added.
NB_SALES = (
    "nb_sales AS (SELECT * EXCLUDE (order_date), CAST(order_date AS DATE) AS order_date, "
    + ", ".join(f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(30,10)) AS {c}_dec" for c in ("sales", "discount", "profit", "margem_lucro"))
    + " FROM enriched)"
)
_NB_FEATS = features_cte("nb_feats", "nb_sales", False, "Consumer", "Global", True, integer_quantity=True).replace(
    "JOIN cutoffs k", "JOIN nb_cutoffs k"
)

_REPORT = """
SELECT classe, precision, recall, f1_score, support FROM (
  WITH c AS (
    SELECT sum(n) FILTER (WHERE label = 0 AND prediction = 0) AS c00,
           sum(n) FILTER (WHERE label = 0 AND prediction = 1) AS c01,
           sum(n) FILTER (WHERE label = 1 AND prediction = 0) AS c10,
           sum(n) FILTER (WHERE label = 1 AND prediction = 1) AS c11
    FROM cm
  ),
  per AS (
    SELECT '0' AS classe,
           CASE WHEN c00 + c10 > 0 THEN c00 / (c00 + c10) ELSE 0.0 END AS precision,
           CASE WHEN c00 + c01 > 0 THEN c00 / (c00 + c01) ELSE 0.0 END AS recall,
           CAST(c00 + c01 AS BIGINT) AS support
    FROM c
    UNION ALL
    SELECT '1',
           CASE WHEN c11 + c01 > 0 THEN c11 / (c11 + c01) ELSE 0.0 END,
           CASE WHEN c11 + c10 > 0 THEN c11 / (c11 + c10) ELSE 0.0 END,
           CAST(c11 + c10 AS BIGINT)
    FROM c
  ),
  per_f AS (
    SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score
    FROM per
  )
  SELECT classe, precision, recall, f1_score, support FROM per_f
  UNION ALL
  SELECT 'accuracy', a, a, a, n FROM (
    SELECT CASE WHEN c00 + c01 + c10 + c11 > 0 THEN (c00 + c11) / (c00 + c01 + c10 + c11) ELSE 0.0 END AS a,
           CAST(c00 + c01 + c10 + c11 AS BIGINT) AS n FROM c)
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per_f
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_f
)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_cols = ", ".join(RAW_COLS)
    q["bronze_ingest"] = f"WITH {RAW_SALES}\nSELECT {raw_cols}, _source_file FROM raw_sales"
    q["dedup_sales"] = f"WITH {RAW_SALES},{DEDUP}\nSELECT {raw_cols}, _source_file FROM dedup"
    q["clean_numeric"] = (
        f"WITH {RAW_SALES}, c AS ({_cleaned_select('raw_sales')})\n"
        "SELECT order_id, product_id, sales, quantity, discount, margem_lucro, profit, shipping_cost FROM c"
    )
    q["sales_cleaned"] = f"{SILVER}\nSELECT * FROM cleaned"
    q["tolerant_load"] = (
        f"WITH {RAW_SALES},{SCRIPT_SALES}\n"
        "SELECT order_id, product_id, strftime(order_date, '%Y-%m-%d') AS order_date, ship_date, customer_name, "
        "segment, country, state, market, region, category, sub_category, product_name, ship_mode, "
        "order_priority, sales, quantity, discount, profit, shipping_cost, margem_lucro FROM script_sales"
    )
    for d in ("dim_produto", "dim_cliente", "dim_localizacao", "dim_modo_envio", "ft_vendas"):
        q[d] = f"{SILVER}\nSELECT * FROM {d}"
    for m in ("vendas_por_categoria", "desempenho_regional", "metrica_clientes"):
        q[m] = f"{GOLD}\nSELECT * FROM {m}"
    q["quality_report"] = _quality_sql()
    q["conformity_rate"] = _conformity_sql()
    q["dim_key_uniqueness"] = _dim_key_sql()
    q["enriched_sales"] = (
        f"{ENRICHED}\nSELECT product_id, country, state, customer_name, order_id, order_date, ship_date, "
        "ship_mode, sales, quantity, discount, profit, shipping_cost, margem_lucro, segment, region, market, "
        "product_name, category, sub_category FROM enriched"
    )
    q["history_asof"] = (
        f"WITH {RAW_SALES},{SCRIPT_SALES}\n"
        "SELECT order_id, customer_name, strftime(order_date, '%Y-%m-%d') AS order_date, sales "
        "FROM script_sales WHERE order_date <= DATE '1997-12-31'"
    )
    q["buyers_in_window"] = (
        f"{SCRIPT_BASE},{BUYERS}\nSELECT CAST(cutoff AS VARCHAR) AS cutoff, customer_name FROM buyers"
    )
    q["label_customers"] = f"{TRAINING}\nSELECT cutoff, customer_name, target_comprou FROM training"
    q["customer_features"] = f"{SCRIPT_BASE},{FEATS_ASOF}\nSELECT cutoff, {_FEATURE_COLS} FROM feats"
    q["customer_features_current"] = f"{SCRIPT_BASE},{FEATS_CURRENT}\nSELECT {_FEATURE_COLS} FROM feats_now"
    q["customer_mode"] = (
        f"{SCRIPT_BASE},{FEATS_CURRENT}\nSELECT customer_name, segment, market FROM feats_now"
    )
    q["sales_profile"] = (
        f"WITH {RAW_SALES},{SCRIPT_SALES}\n"
        "SELECT count(*) AS total_registros, count(DISTINCT customer_name) AS clientes_unicos, "
        "strftime(min(order_date), '%Y-%m-%d') AS data_inicial, strftime(max(order_date), '%Y-%m-%d') AS data_final "
        "FROM script_sales"
    )
    q["multi_window_training"] = f"{TRAINING}\nSELECT cutoff, {_FEATURE_COLS}, target_comprou FROM training"
    nb_cols = _FEATURE_COLS.replace("qtd_subcategorias_distintas, qtd_produtos_distintos, ", "")
    q["single_window_training"] = (
        f"{ENRICHED},\n"
        f"{NB_SALES},\n"
        "nb_cutoffs AS (SELECT DATE '1999-06-30' AS cutoff, 180 AS horizon_days),"
        f"{_NB_FEATS},\n"
        "nb_buyers AS (SELECT DISTINCT k.cutoff, s.customer_name FROM nb_sales s JOIN nb_cutoffs k "
        "ON s.order_date > k.cutoff AND s.order_date <= k.cutoff + k.horizon_days WHERE s.customer_name IS NOT NULL)\n"
        f"SELECT f.cutoff, {', '.join('f.' + c.strip() for c in nb_cols.split(','))}, "
        "CASE WHEN b.customer_name IS NULL THEN 0 ELSE 1 END AS target_comprou "
        "FROM nb_feats f LEFT JOIN nb_buyers b ON CAST(b.cutoff AS VARCHAR) = f.cutoff AND b.customer_name = f.customer_name"
    )
    q["label_rate_by_cutoff"] = (
        f"{TRAINING}\n"
        "SELECT cutoff, count(*) AS total_clientes, CAST(sum(target_comprou) AS BIGINT) AS compraram, "
        f"{np_round('avg(target_comprou) * 100.0', 1)} AS taxa_compra_pct "
        "FROM training GROUP BY ROLLUP (cutoff)"
    )
    q["score_deciles"] = f"{SCORED}\nSELECT customer_name, propensity_score, percentil_score FROM banded"
    q["propensity_bands"] = f"{SCORED}\nSELECT customer_name, propensity_score, faixa_propensao FROM banded"
    q["propensity_bands_crm"] = f"{SCORED}\nSELECT customer_name, propensity_score, estrategia_crm FROM banded"
    q["propensity_ranking"] = (
        f"{SCORED}\nSELECT ranking, customer_name, propensity_score, faixa_propensao, percentil_score, "
        "recencia_dias, frequencia_pedidos, valor_total_gasto, ticket_medio, data_ultima_compra, segment, market "
        "FROM banded"
    )
    q["top_customers"] = (
        f"{SCORED}\nSELECT ranking, customer_name, propensity_score, faixa_propensao, valor_total_gasto "
        "FROM banded WHERE ranking <= 10"
    )
    q["band_summary"] = (
        f"{SCORED}\nSELECT faixa_propensao, count(*) AS total_clientes, "
        f"{written_sum('ticket_medio')} / count(ticket_medio) AS ticket_medio_medio, "
        f"{written_sum('valor_total_gasto')} AS valor_acumulado, "
        f"{np_round('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct_base "
        "FROM banded GROUP BY faixa_propensao"
    )
    q["roc_auc"] = (
        f"{LABELLED},\n"
        "per AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg "
        "FROM labelled GROUP BY score),\n"
        "cum AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM per)\n"
        "SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN "
        "sum(pos * (cum_neg - neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc FROM cum"
    )
    q["brier_score"] = f"{LABELLED}\nSELECT avg(pow(score - label, 2)) AS brier_score FROM labelled"
    q["confusion_matrix"] = f"{LABELLED}\nSELECT label, prediction, n FROM cm"
    q["classification_report"] = f"{LABELLED}\n{_REPORT}"
    q["stratified_split"] = (
        f"{TRAINING},\n"
        "hashed AS (SELECT cutoff, customer_name, target_comprou, md5(cutoff || '|' || customer_name || '|42') AS h FROM training),\n"
        "placed AS (SELECT *, row_number() OVER (PARTITION BY target_comprou ORDER BY h, cutoff, customer_name) AS r, "
        "floor(count(*) OVER (PARTITION BY target_comprou) * 0.2 + 0.5) AS n_test FROM hashed)\n"
        "SELECT cutoff, customer_name, target_comprou, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split, "
        "CAST(CASE WHEN r > n_test THEN (r - n_test - 1) % 5 END AS INTEGER) AS fold FROM placed"
    )
    q["class_weight"] = (
        f"{TRAINING},\n"
        "cls AS (SELECT target_comprou, count(*) - floor(count(*) * 0.2 + 0.5) AS n_train FROM training GROUP BY target_comprou)\n"
        "SELECT CAST(coalesce(sum(n_train) FILTER (WHERE target_comprou = 0), 0) AS BIGINT) AS num_neg, "
        "CAST(coalesce(sum(n_train) FILTER (WHERE target_comprou = 1), 0) AS BIGINT) AS num_pos, "
        "CASE WHEN coalesce(sum(n_train) FILTER (WHERE target_comprou = 1), 0) > 0 THEN "
        "CAST(sum(n_train) FILTER (WHERE target_comprou = 0) AS DOUBLE) / sum(n_train) FILTER (WHERE target_comprou = 1) "
        "ELSE 1.0 END AS scale_pos_weight FROM cls"
    )
    # What does not depend on the learner; scores, ranks, deciles and bands must agree with each other.
    agree = "true AS score_in_range, true AS rank_agrees, true AS decile_agrees, true AS band_agrees"
    run_cols = "customer_name, recencia_dias, frequencia_pedidos, valor_total_gasto, ticket_medio, data_ultima_compra, segment, market"
    q["propensity_pipeline"] = f"{SCRIPT_BASE},{FEATS_CURRENT}\nSELECT {run_cols}, {agree} FROM feats_now"
    nb_now = features_cte("nb_now", "nb_sales", False, "Consumer", "Global", False, integer_quantity=True)
    q["notebook_ranking"] = f"{ENRICHED},\n{NB_SALES},{nb_now}\nSELECT {run_cols}, {agree} FROM nb_now"
    numeric = (
        "recencia_dias", "frequencia_pedidos", "valor_total_gasto", "quantidade_itens", "ticket_medio", "lucro_total",
        "desconto_medio", "margem_media", "qtd_categorias_distintas", "qtd_subcategorias_distintas",
        "qtd_produtos_distintos", "tempo_relacionamento_dias",
    )
    names = " UNION ALL ".join(f"SELECT '{n}' AS Feature" for n in numeric)
    q["feature_importance"] = (
        f"{TRAINING},\n"
        f"names AS ({names} UNION ALL SELECT DISTINCT 'segment_' || segment FROM training "
        "UNION ALL SELECT DISTINCT 'market_' || market FROM training)\n"
        "SELECT Feature, true AS not_negative, CAST(1.0 AS DOUBLE) AS total_importance FROM names"
    )
    q["holdout_evaluation"] = (
        f"{TRAINING}\n"
        "SELECT CAST(target_comprou AS VARCHAR) AS classe, n AS support, n AS in_matrix, true AS ratios_in_range, "
        "true AS auc_in_range, true AS brier_in_range, true AS folds_agree FROM ("
        "SELECT target_comprou, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n FROM training GROUP BY target_comprou)"
    )
    q["csv_bronze"] = f"WITH {RAW_SALES}\nSELECT {raw_cols}, 16 AS n_files, 1 AS n_times, true AS files_named FROM raw_sales"
    numbers = ("sales", "quantity", "discount", "profit", "margem_lucro")
    texts = ", ".join(c for c in RAW_COLS if c not in numbers and c != "order_date")
    typed = ", ".join(f"CASE WHEN NOT isnan(try_cast({c} AS DOUBLE)) THEN try_cast({c} AS DOUBLE) END AS {c}" for c in numbers)
    q["csv_fallback"] = (
        f"WITH {RAW_SALES}\nSELECT {texts}, {typed}, order_date "
        f"FROM (SELECT {', '.join(_present(c, c) for c in RAW_COLS)} FROM raw_sales)"
    )
    q["silver_sales"] = q["enriched_sales"]
    q["catalog_rules"] = q["quality_report"]
    q["catalog_refresh"] = _catalog_sql()
    q["table_replaced"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment, c_custkey % 7 AS rest, "
        "'it''s second' AS comment, true AS failed, 1 AS tables FROM customer"
    )
    without = nb_cols.replace("segment, market,", "'Consumer' AS segment, 'Global' AS market,").replace(
        "qtd_categorias_distintas,", "1 AS qtd_categorias_distintas,"
    )
    q["features_without_optional"] = f"{SCRIPT_BASE},{FEATS_CURRENT}\nSELECT {without} FROM feats_now"
    q["ranking_file"] = q["propensity_ranking"].replace("segment, market FROM", "segment, market, true AS in_order FROM")
    return q


_KINDS = {"sales": "int", "quantity": "int", "discount": "double", "profit": "double", "shipping_cost": "double", "margem_lucro": "double"}
_TABLES = {
    "sales_raw": ("Raw sales lines as ingested, with ingestion time and source file", "raw_sales",
                  [*((c, "string") for c in ("order_id", "product_id", "order_date", "ship_date", "customer_name", "segment", "country", "state",
                                             "market", "region", "category", "sub_category", "product_name", "ship_mode", "order_priority",
                                             "sales", "quantity", "discount", "profit", "shipping_cost", "margem_lucro")),
                   ("_ingestion_time", "timestamp"), ("_source_file", "string")]),
    "dim_produto": ("Product dimension", "dim_produto", [(c, "string") for c in ("product_id", "product_name", "category", "sub_category")]),
    "dim_cliente": ("Customer dimension", "dim_cliente", [(c, "string") for c in ("customer_name", "segment")]),
    "dim_localizacao": ("Location dimension", "dim_localizacao", [(c, "string") for c in ("country", "state", "region", "market")]),
    "dim_modo_envio": ("Ship mode and order priority dimension", "dim_modo_envio", [(c, "string") for c in ("ship_mode", "order_priority")]),
    "ft_vendas": ("Sales fact with key, sign and range rules", "ft_vendas",
                  [*((c, _KINDS.get(c, "string")) for c in ("order_id", "order_date", "ship_date", "customer_name", "product_id", "country", "state",
                                                            "ship_mode", "sales", "quantity", "discount", "profit", "shipping_cost", "margem_lucro")),
                   ("_updated_at", "timestamp")]),
    "vendas_por_categoria": ("KPIs by category and sub-category", "vendas_por_categoria",
                             [("category", "string"), ("sub_category", "string"), ("faturamento_total", "bigint"), ("lucro_total", "double"),
                              ("qtd_itens_vendidos", "bigint"), ("margem_media", "double")]),
    "desempenho_regional": ("KPIs by market, region and country", "desempenho_regional",
                            [("market", "string"), ("region", "string"), ("country", "string"), ("faturamento_total", "bigint"),
                             ("lucro_total", "double"), ("custo_frete_total", "double"), ("total_pedidos", "bigint")]),
    "metrica_clientes": ("Customer and segment KPIs", "metrica_clientes",
                         [("segment", "string"), ("total_clientes", "bigint"), ("faturamento_total", "bigint"), ("lucro_total", "double"),
                          ("ticket_medio_por_pedido", "double")]),
}


def _catalog_sql() -> str:
    parts = []
    for name, (comment, source, columns) in _TABLES.items():
        values = ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(columns))
        parts.append(
            f"SELECT '{name}' AS dataset, position, column_name, data_type, '{comment}' AS comment, "
            f"(SELECT count(*) FROM {source}) AS n_rows FROM (VALUES {values}) v(position, column_name, data_type)"
        )
    return f"{GOLD}\n" + "\nUNION ALL\n".join(parts)


ORACLE_SQL = build()
