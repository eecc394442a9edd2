"""Typed scans of the two master-data CSVs that ship with the sales data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PRODUCT_CATALOGUE_SCHEMA, SALESPEOPLE_SCHEMA


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    # Empty fields are NULL for every type (an empty launch or exit date).
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("encoding", "UTF-8")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_product_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, PRODUCT_CATALOGUE_SCHEMA)


def read_salespeople(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SALESPEOPLE_SCHEMA)
