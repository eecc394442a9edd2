"""Order lines in the raw sales shape, derived from TPC-H-style tables.

The sales file of the reference is not available, so the test and benchmark
tables (``lineitem orders customer nation region part``) are mapped onto it:
one raw order line per ``lineitem`` row, every column a string, with dirty
values injected by fixed key rules (quotes, decimal commas, text that is not a
number, negative amounts, NULL keys, a second product name that fans out the
product dimension). The same rules are written in DuckDB SQL for the oracle.

Scale: customers are joined to orders, not to lines, and parts, whose columns are
the narrower, to lines before that; so the lines are shuffled twice, by part and
by order. How each join runs is left to the optimizer. Only ``nation`` and
``region`` are broadcast explicitly: TPC-H fixes them at 25 and 5 rows at
every scale factor. The number of partitions follows the bytes of the tables
(``size_shuffles``), so no task's sort grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SALES_COLUMNS
from ..session import size_shuffles

TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")


def table_paths(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{n}.parquet" for n in TABLES]


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _txt(c: Column) -> Column:
    return c.cast("string")


def _dirty_columns(with_dirt: bool) -> dict[str, Column]:
    key = F.col("l_orderkey")
    price = F.col("l_extendedprice")
    price_txt = _txt(price)
    disc = F.col("l_discount")
    disc_txt = _txt(disc)
    margin = F.lit(0.15).cast("decimal(2,2)") - disc
    profit_txt = _txt((price * margin).cast("decimal(14,2)"))
    ship_txt = _txt((price * F.col("l_tax")).cast("decimal(14,2)"))
    qty_txt = _txt(F.col("l_quantity"))
    if not with_dirt:
        return {
            "order_id": F.concat(F.lit("O"), _txt(key)),
            "product_id": F.concat(F.lit("P"), _txt(F.col("l_partkey"))),
            "product_name": F.col("p_name"),
            "sales": price_txt,
            "quantity": qty_txt,
            "discount": disc_txt,
            "profit": profit_txt,
            "shipping_cost": ship_txt,
            "margem_lucro": _txt(margin),
        }
    return {
        "order_id": F.when(key % 499 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("O"), _txt(key))
        ),
        "product_id": F.when(F.col("l_partkey") % 997 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("P"), _txt(F.col("l_partkey")))
        ),
        "product_name": F.when(
            F.col("_other_name"), F.concat(F.col("p_name"), F.lit(" II"))
        ).otherwise(F.col("p_name")),
        "sales": F.when(key % 101 == 0, F.lit("1,234"))
        .when(key % 7 == 0, F.concat(F.lit('"'), price_txt, F.lit(' "')))
        .when(key % 53 == 0, F.concat(F.lit("-"), price_txt))
        .when(key % 103 == 0, F.concat(price_txt, F.lit("123457")))
        .otherwise(price_txt),
        "quantity": F.when(key % 89 == 0, F.lit("0"))
        .when(key % 97 == 0, F.lit("n/a"))
        .when(key % 83 == 0, F.lit("NaN"))
        .otherwise(qty_txt),
        "discount": F.when(key % 211 == 0, F.lit("1.50"))
        .when(F.col("_even_line"), F.translate(disc_txt, ".", ","))
        .otherwise(disc_txt),
        "profit": profit_txt,
        "shipping_cost": F.when(key % 307 == 0, F.lit("-1.00")).otherwise(ship_txt),
        "margem_lucro": F.when(key % 2 == 0, F.translate(_txt(margin), ".", ",")).otherwise(_txt(margin)),
        "customer_name": F.when(key % 1499 == 0, F.lit("NA")).otherwise(F.col("c_name")),
    }


#: Lines travel through the joins with two amounts of at most 99.99 and two flags as one number; no value is code 0.
_AMOUNT_CODES, _FLAG_CODES = 1 << 15, 4


def _packed_line() -> Column:
    def amount(name: str) -> Column:
        return F.coalesce((F.col(name).cast("decimal(4,2)") * 100).cast("long") + 10_000, F.lit(0))

    def flag(c: Column) -> Column:
        return F.coalesce(c.cast("long") + 1, F.lit(0))

    flags = flag(F.col("l_suppkey") % 20 == 0) * _FLAG_CODES + flag(F.col("l_linenumber") % 2 == 0)
    return (amount("l_discount") * _AMOUNT_CODES + amount("l_tax")) * _FLAG_CODES**2 + flags


def _unpacked_line(packed: Column) -> dict[str, Column]:
    def amount(code: Column) -> Column:
        return F.when(code > 0, ((code - 10_000).cast("decimal(6,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(4,2)"))

    def flag(code: Column) -> Column:
        return F.when(code > 0, code == 2)

    amounts = F.shiftright(packed, 4)
    return {
        "l_discount": amount(F.shiftright(amounts, 15)),
        "l_tax": amount(amounts % _AMOUNT_CODES),
        "_other_name": flag(F.shiftright(packed, 2) % _FLAG_CODES),
        "_even_line": flag(packed % _FLAG_CODES),
    }


def raw_sales_from_tables(tables: dict[str, DataFrame], with_dirt: bool = True, by_order: int | None = None) -> DataFrame:
    """Raw order lines (21 string columns + ``_source_file``), one per lineitem.

    ``by_order``: the join with the orders leaves the lines in this many partitions, those of an order in one.
    """
    # typed before the joins: what the shuffles move is narrower, and packs better, than doubles and times
    li = tables["lineitem"].select(
        "l_orderkey", "l_partkey", "l_linestatus",
        _packed_line().alias("_packed"),
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.col("_metadata.file_name").alias("_source_file"),
    )
    orders = tables["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    geo = tables["nation"].join(
        F.broadcast(tables["region"]), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    customer = tables["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    part = tables["part"].select("p_partkey", "p_name", "p_brand", "p_type")

    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    li = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if by_order:
        li, ordered = li.repartition(by_order, "l_orderkey"), ordered.repartition(by_order, "o_orderkey")
    joined = (
        li.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = joined.withColumns(_unpacked_line(F.col("_packed")))
    dirty = _dirty_columns(with_dirt)
    columns = {
        "order_id": dirty["order_id"],
        "product_id": dirty["product_id"],
        "order_date": _txt(F.col("o_orderdate")),
        "ship_date": _txt(F.col("l_shipdate")),
        "customer_name": dirty.get("customer_name", F.col("c_name")),
        "segment": F.col("c_mktsegment"),
        "country": F.col("n_name"),
        "state": F.concat(F.col("n_name"), F.lit("-"), _txt(F.col("c_custkey") % 4)),
        "market": F.col("r_name"),
        "region": F.concat(F.col("r_name"), F.lit("-"), _txt(F.col("n_nationkey") % 2)),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_name": dirty["product_name"],
        "ship_mode": F.col("l_linestatus"),
        "order_priority": F.col("o_orderpriority"),
        "sales": dirty["sales"],
        "quantity": dirty["quantity"],
        "discount": dirty["discount"],
        "profit": dirty["profit"],
        "shipping_cost": dirty["shipping_cost"],
        "margem_lucro": dirty["margem_lucro"],
    }
    assert tuple(columns) == SALES_COLUMNS
    return joined.select(*[c.alias(n) for n, c in columns.items()], "_source_file")


def raw_sales(spark: SparkSession, sf_dir: str, with_dirt: bool = True, by_order_in: int | None = None) -> DataFrame:
    """Raw order lines without the ingestion-time column (see ``bronze_from_tables``).

    ``by_order_in``: no order is in two partitions, whose number is a multiple of this one.
    """
    tables = read_tables(spark, sf_dir)
    n = size_shuffles(spark, table_paths(sf_dir))
    return raw_sales_from_tables(tables, with_dirt, by_order_in and by_order_in * -(-n // by_order_in))


def bronze_from_tables(spark: SparkSession, sf_dir: str, with_dirt: bool = True) -> DataFrame:
    """``sales_raw`` built from the tables: raw lines plus both lineage columns."""
    raw = raw_sales(spark, sf_dir, with_dirt)
    return raw.select(*SALES_COLUMNS, F.current_timestamp().alias("_ingestion_time"), "_source_file")
