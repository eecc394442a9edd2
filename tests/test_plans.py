"""Physical-plan properties the design relies on (read from the executed plan)."""

from __future__ import annotations

import itertools
import os
import re

import pytest
from pyspark.sql import functions as F

from lakemart.operators import features as feat
from lakemart.operators import marts
from lakemart.operators.dedup import dedup_by_key
from lakemart.plans import medallion
from lakemart.plans import table_queries as tq
from tests.conftest import SF_SMALL

needs_data = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_scan_prunes_columns(spark):
    plan = plan_of(tq.raw_lines(spark, SF_SMALL))
    lineitem_scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln]
    assert lineitem_scans
    # l_returnflag is never used: it must not be read
    assert all("l_returnflag" not in ln for ln in lineitem_scans)


@needs_data
def test_mart_pre_aggregates_the_fact_below_the_join(spark):
    ds = tq.datasets(spark, SF_SMALL)
    plan = plan_of(marts.metrica_clientes(ds["ft_vendas"], ds["dim_cliente"]))
    lines = plan.splitlines()
    join_at = next(i for i, ln in enumerate(lines) if "Join" in ln)
    below = "\n".join(lines[join_at:])
    assert re.search(r"HashAggregate\(keys=\[customer_name#\d+, order_id#\d+\]", below)


@needs_data
def test_training_set_pairs_no_line_with_a_cutoff(spark):
    plan = plan_of(tq.training(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "Expand" not in plan
    # the one-row frames (ends and number of the cutoffs) are all that is joined without a key
    conditions = re.findall(r"BroadcastNestedLoopJoin BuildRight, Cross(.*)", plan)
    assert len(conditions) == plan.count("BroadcastNestedLoopJoin")
    assert not any("order_date" in c for c in conditions)


@needs_data
def test_one_reader_queries_store_nothing(spark):
    for name in ("q_sales_profile", "q_history_asof", "q_tolerant_load"):
        plan = getattr(tq, name)(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "stored-" not in plan and "ExistingRDD" not in plan
    plan = plan_of(tq.q_sales_profile(spark, SF_SMALL))
    assert "p_brand" not in plan and "l_tax" not in plan


@needs_data
def test_dedup_sorts_rows_of_repeated_keys_only(spark):
    from lakemart.session import store

    raw = store(tq.raw_lines(spark, SF_SMALL))
    plan = plan_of(dedup_by_key(raw, ["order_id", "product_id"]))
    # every sort aggregate stands above the join that picks repeated keys; single rows pass one anti join
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "SortAggregate" in ln:
            below = [x for j, x in enumerate(lines[i + 1 :]) if all(depth(y) > depth(ln) for y in lines[i + 1 : i + 2 + j])]
            assert any("LeftSemi" in x for x in below)
    assert "LeftAnti" in plan and "SortAggregate" in plan
    keys_only = [ln for ln in lines if "FileScan" in ln and "product_name" not in ln]
    assert keys_only  # the count reads the key columns alone


def test_ids_of_orders_and_products_meet_no_window(spark):
    sales = spark.createDataFrame(
        [("c", "o", "p", "k", "s", "a", "m", "2020-01-01", 1.0, 1.0, 0.1, 1.0, 0.1)],
        "customer_name string, order_id string, product_id string, category string, sub_category string, segment string, market string, "
        "order_date string, sales double, quantity double, discount double, profit double, margem_lucro double",
    )
    plan = feat.bucket_totals(sales, feat.cutoff_frame(spark, ["2020-06-30"]))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    of_values = [i for i, ln in enumerate(lines) if "Window" in ln and "_seen" in ln]
    assert of_values  # the running count of segments and markets
    for i in of_values:
        below = list(itertools.takewhile(lambda x: depth(x) > depth(lines[i]), lines[i + 1 :]))
        assert any("segment" in x and "market" in x for x in below if "Generate explode" in x)
        assert not any("order_id" in x or "product_id" in x for x in below if "Generate explode" in x)


def test_a_customer_with_a_third_of_the_orders_is_spread(spark):
    rows = 30_000
    lines = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 997)).alias("customer_name"),
        (F.col("id") % 4 + 1).cast("int").alias("_bucket"),
        F.concat(F.lit("o"), F.col("id")).alias("order_id"),
        F.lit("s").alias("segment"),
    )
    first = feat._new_values(lines, {"frequencia_pedidos": "order_id"})
    assert {r[0] for r in first.agg(F.sum("frequencia_pedidos")).collect()} == {rows}
    # rows of the shuffle below the minimum, by task
    pairs = feat._pairs(lines, ["order_id"]).repartition(16, "customer_name", "_column", "_value")
    sizes = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    counts = feat._pairs(lines, ["segment"]).groupBy("customer_name", "_column", "_value", "_bucket").count()
    assert counts.filter("customer_name = 'hot'").count() == 4  # what the windows see of it


@needs_data
def test_stored_view_holds_what_the_mart_reads(spark):
    ds = tq.shared_datasets(spark, SF_SMALL, "vendas_por_categoria")
    assert set(ds.pre("sales_cleaned_view").columns) == {
        "order_id", "product_id", "product_name", "category", "sub_category", "sales", "quantity", "profit", "margem_lucro",
    }
    assert ds["vendas_por_categoria"].columns == list(medallion.build(tq.bronze(spark, SF_SMALL))["vendas_por_categoria"].columns)
    assert medallion.view_columns(["sales_cleaned_view", "dim_cliente"]) is None
    assert medallion.view_columns(["dim_cliente"]) == {"customer_name", "segment"}


@needs_data
def test_quality_report_reads_the_lines_once(spark):
    """All but the raw lines' and the fact's rules come from one stored grouping."""
    report = medallion.quality_report(tq.bronze(spark, SF_SMALL), store_view=True)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "p_name" not in plan and "l_orderkey" not in plan
    scans = {ln.split("Relation ")[1].split("]")[0] for ln in plan.splitlines() if "Relation " in ln}
    assert all("dataset" in x and "k0" in x for x in scans)
