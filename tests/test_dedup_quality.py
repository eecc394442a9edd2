"""Deterministic de-duplication and the 19 named quality rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakemart.config import QUALITY_RULES
from lakemart.operators.dedup import dedup_by_key
from lakemart.operators.quality import Expectation, apply_expectations, conformity, rule_counts, rules_for
from tests.conftest import rows


def test_dedup_keeps_smallest_row_nulls_first(spark):
    df = spark.createDataFrame(
        [("o1", "p1", "b", "x"), ("o1", "p1", "a", "z"), ("o1", "p1", None, "y"),
         ("o2", "p1", "c", "c"), (None, None, "k", "1"), (None, None, "j", "2")],
        "order_id string, product_id string, a string, b string",
    )
    out = rows(dedup_by_key(df, ["order_id", "product_id"]))
    assert out == rows(spark.createDataFrame(
        [("o1", "p1", None, "y"), ("o2", "p1", "c", "c"), (None, None, "j", "2")], df.schema))


def test_dedup_is_idempotent_and_keeps_columns(spark):
    df = spark.createDataFrame([(i % 3, i % 2, i) for i in range(20)], "k1 int, k2 int, v int")
    once = dedup_by_key(df, ["k1", "k2"])
    assert once.columns == df.columns
    assert rows(dedup_by_key(once, ["k1", "k2"])) == rows(once)
    assert once.count() == 6


def test_dedup_hot_key_is_combined_map_side(spark):
    # one key holds most rows; the plan must aggregate partially before the shuffle
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * 7 % 5000).alias("v"),
    )
    out = dedup_by_key(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert out.filter("k = 'hot'").first()["v"] == 0


def test_nineteen_rules_exist_with_actions():
    assert len(QUALITY_RULES) == 19
    names = [r[1] for r in QUALITY_RULES]
    assert len(set(names)) == 19
    drops = [r[1] for r in QUALITY_RULES if r[3] == "drop"]
    assert drops == ["valid_product_id", "valid_customer_name", "valid_location", "valid_ship_mode",
                     "valid_primary_keys", "valid_positive_sales", "valid_positive_quantity"]


# one passing, one failing and one NULL row for every rule
RULE_CASES = {
    "valid_source_file_metadata": ("_source_file string", ["f.csv"], [None], None),
    "valid_product_id": ("product_id string", ["p"], [None], None),
    "valid_product_name": ("product_name string", ["n"], [None], None),
    "valid_customer_name": ("customer_name string", ["c"], [None], None),
    "valid_segment": ("segment string", ["s"], [None], None),
    "valid_location": ("country string, state string", ["BR", "SP"], ["BR", None], [None, None]),
    "valid_ship_mode": ("ship_mode string", ["m"], [None], None),
    "valid_primary_keys": ("order_id string, product_id string", ["o", "p"], [None, "p"], ["o", None]),
    "valid_positive_sales": ("sales int", [1], [0], [None]),
    "valid_positive_quantity": ("quantity int", [3], [-1], [None]),
    "valid_discount_range": ("discount double", [0.5], [1.5], [None]),
    "valid_shipping_cost": ("shipping_cost double", [0.0], [-1.0], [None]),
    "valid_dates_chronology": ("order_date string, ship_date string", ["2020-01-01", "2020-01-02"],
                               ["2020-01-03", "2020-01-02"], [None, "2020-01-02"]),
    "valid_category_revenue": ("faturamento_total long", [10], [0], [None]),
    "valid_category_items": ("qtd_itens_vendidos long", [1], [0], [None]),
    "valid_regional_revenue": ("faturamento_total long", [10], [-3], [None]),
    "valid_orders_count": ("total_pedidos long", [2], [0], [None]),
    "valid_segment_revenue": ("faturamento_total long", [5], [0], [None]),
    "valid_ticket_medio": ("ticket_medio_por_pedido double", [1.5], [0.0], [None]),
}


@pytest.mark.parametrize("dataset,name,predicate,action", QUALITY_RULES, ids=[r[1] for r in QUALITY_RULES])
def test_rule_pass_fail_null(spark, dataset, name, predicate, action):
    schema, good, bad, null = RULE_CASES[name]
    width = len(schema.split(","))
    null = null if null is not None else [None] * width
    df = spark.createDataFrame([tuple(good), tuple(bad), tuple(null)], schema)
    rule = Expectation(name, predicate, action)
    counts = rule_counts(df, [rule], dataset).first()
    assert (counts["total_rows"], counts["passed"], counts["failed"]) == (3, 1, 2)
    kept = apply_expectations(df, [rule]).count()
    assert kept == (1 if action == "drop" else 3)


def test_counts_are_taken_before_drops_and_add_up(spark):
    df = spark.createDataFrame(
        [("o", "p", 1, 1), (None, "p", 1, 1), ("o", "p", 0, 1), ("o", "p", 1, None)],
        "order_id string, product_id string, sales int, quantity int",
    )
    rules = [r for r in rules_for("ft_vendas") if r.name in
             ("valid_primary_keys", "valid_positive_sales", "valid_positive_quantity")]
    got = {r["rule"]: r["failed"] for r in rule_counts(df, rules, "ft_vendas").collect()}
    assert got == {"valid_primary_keys": 1, "valid_positive_sales": 1, "valid_positive_quantity": 1}
    c = conformity(df, rules, "ft_vendas").first()
    assert (c["input_rows"], c["kept_rows"], c["dropped_rows"]) == (4, 1, 3)
    assert c["kept_rows"] + c["dropped_rows"] == c["input_rows"]
