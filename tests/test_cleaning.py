"""Silver cleaning: quote/space stripping, decimal commas, safe casts, truncation."""

from __future__ import annotations

import pytest

from lakemart.functions.cleaning import SALES_CLEANING, clean_columns
from lakemart.functions.numeric import round_half_even


def _clean_one(spark, column, values):
    other = [s.name for s in SALES_CLEANING if s.name != column]
    schema = ", ".join(f"{c} string" for c in [column] + other)
    data = [(v,) + (None,) * len(other) for v in values]
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in clean_columns(df).select(column).collect()]


def test_sales_strip_truncate_and_null(spark):
    got = _clean_one(spark, "sales", ["12", '"12"', " 12 ", "12.9", "1,234", "-5", "0.9", "99999999999", "abc", None])
    # stripped, truncated toward zero; a decimal comma is not repaired for sales;
    # an out-of-range value becomes NULL instead of failing the job
    assert got == [12, 12, 12, 12, None, -5, 0, None, None, None]


def test_quantity(spark):
    assert _clean_one(spark, "quantity", ["2", "0", "n/a", " 3 ", '"4"']) == [2, 0, None, 3, 4]


def test_discount_decimal_comma(spark):
    assert _clean_one(spark, "discount", ["0.1", "0,15", "1.50", "-0.1", "", None]) == [0.1, 0.15, 1.5, -0.1, None, None]


def test_margin_rounded_half_up(spark):
    assert _clean_one(spark, "margem_lucro", ["0,12345", "x", '" 0,5 "']) == [0.1235, None, 0.5]


def test_profit_and_shipping_not_cleaned(spark):
    # no stripping and no comma repair for these two columns
    assert _clean_one(spark, "profit", ["1.239", "3,5", "", '"2"']) == [1.24, None, None, None]
    assert _clean_one(spark, "shipping_cost", ["9.999", "-1.00"]) == [10.0, -1.0]


@pytest.mark.parametrize(
    "value,scale,expected",
    [(0.125, 2, 0.12), (0.135, 2, 0.14), (2.5, 0, 2.0), (3.5, 0, 4.0), (-0.125, 2, -0.12), (1.23456, 4, 1.2346)],
)
def test_round_half_even_binary(spark, value, scale, expected):
    from pyspark.sql import functions as F

    got = spark.range(1).select(round_half_even(F.lit(value), scale).alias("r")).first()["r"]
    assert got == expected
