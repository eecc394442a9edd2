"""What tasks and shuffles hold must not grow faster than the input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakemart import session
from lakemart.sources import tpch_sales
from tests.conftest import SF_SMALL

needs_data = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_begin_with_partitions_by_bytes(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t.parquet"
    spark.range(20_000).select(F.rand(1).alias("x")).coalesce(1).write.parquet(path)
    kept = spark.conf.get(INITIAL, None)
    try:
        assert session.size_shuffles(spark, [path]) == session.shuffle_partitions(spark)  # never fewer
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
        one, two = session.size_shuffles(spark, [path]), session.size_shuffles(spark, [path, path])
        assert one > session.shuffle_partitions(spark) and 2 * one - 1 <= two <= 2 * one
        assert spark.conf.get(INITIAL) == str(two)
    finally:
        spark.conf.set(INITIAL, kept) if kept else spark.conf.unset(INITIAL)


@needs_data
def test_raw_lines_size_their_shuffles(spark, monkeypatch):
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 4_000)
    kept = spark.conf.get(INITIAL, None)
    try:
        raw = tpch_sales.raw_sales(spark, SF_SMALL)
        assert int(spark.conf.get(INITIAL)) > 10
        assert raw.count() == 6000
    finally:
        spark.conf.set(INITIAL, kept) if kept else spark.conf.unset(INITIAL)


@needs_data
def test_csv_lines_go_to_the_files_by_order(spark, monkeypatch):
    """From some size on an order's lines stand together in one of the 16 files; below it lines are dealt out in turn."""
    from lakemart.plans import table_queries as tq

    def split_orders(folder):
        lines = spark.read.option("header", "true").csv(folder).select("order_id", F.col("_metadata.file_name").alias("file"))
        assert lines.count() == 6000 and lines.select("file").distinct().count() == tq.CSV_FILES
        return lines.filter("order_id is not null").groupBy("order_id").agg(F.count_distinct("file").alias("n")).filter("n > 1").count()

    assert split_orders(tq.csv_files(spark, SF_SMALL)) > 0
    monkeypatch.setattr(tq, "CSV_BY_ORDER", 1)
    assert split_orders(tq.csv_files(spark, SF_SMALL)) == 0
    assert [r[0] for r in tq.q_csv_bronze(spark, SF_SMALL).select("n_files").distinct().collect()] == [16]


@needs_data
def test_csv_lines_are_not_shuffled_once_they_are_texts(spark, monkeypatch):
    """The files are made of the join's own partitions: the plan's exchanges lie below it."""
    from lakemart.plans import table_queries as tq

    monkeypatch.setattr(tq, "CSV_BY_ORDER", 1)
    lines = tq.csv_lines(spark, SF_SMALL)
    plan = lines._jdf.queryExecution().sparkPlan().toString()
    assert lines.rdd.getNumPartitions() == tq.CSV_FILES
    assert plan.index("Coalesce") < plan.index("Join") < plan.index("Exchange")
