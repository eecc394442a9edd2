"""Star schema and marts on hand-made lines, including the dimension fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.config import SALES_COLUMNS
from lakemart.operators import marts, star
from lakemart.operators.enrich import enrich_sales
from lakemart.plans import medallion
from tests.conftest import rows

SCHEMA = ", ".join(f"{c} string" for c in SALES_COLUMNS) + ", _ingestion_time timestamp, _source_file string"


def line(order_id, product_id, customer="ana", segment="Consumer", product_name="Perfume", sales="100",
         quantity="2", profit="10.00", shipping="5.00", margin="0,10", discount="0.1", state="SP",
         order_date="2020-01-01", ship_date="2020-01-03"):
    values = dict(
        order_id=order_id, product_id=product_id, order_date=order_date, ship_date=ship_date,
        customer_name=customer, segment=segment, country="BR", state=state, market="LATAM",
        region="Sudeste", category="Fragrance", sub_category="EDP", product_name=product_name,
        ship_mode="Standard", order_priority="High", sales=sales, quantity=quantity,
        discount=discount, profit=profit, shipping_cost=shipping, margem_lucro=margin,
    )
    return tuple(values[c] for c in SALES_COLUMNS) + (None, "f.csv")


def bronze(spark, lines):
    return spark.createDataFrame(lines, SCHEMA)


def test_fact_drops_and_marts(spark):
    b = bronze(spark, [
        line("o1", "p1", sales="100", profit="10.00"),
        line("o1", "p2", sales="50", profit="5.50", customer="bia", segment="Corporate"),
        line("o2", "p1", sales="0"),              # dropped: sales > 0
        line("o3", None, sales="10"),             # dropped: key NULL
        line("o4", "p1", quantity="n/a"),         # dropped: quantity NULL
        line("o1", "p1", sales="999"),            # duplicate key: the smaller row survives
    ])
    ds = medallion.build(b)
    assert ds["ft_vendas"].count() == 2
    m = {r["segment"]: r for r in ds["metrica_clientes"].collect()}
    assert m["Consumer"]["faturamento_total"] == 100 and m["Corporate"]["faturamento_total"] == 50
    assert m["Consumer"]["ticket_medio_por_pedido"] == 100.0
    v = ds["vendas_por_categoria"].first()
    assert (v["faturamento_total"], v["lucro_total"], v["qtd_itens_vendidos"], v["margem_media"]) == (150, 15.5, 4, 0.1)
    r = ds["desempenho_regional"].first()
    assert (r["faturamento_total"], r["total_pedidos"], r["custo_frete_total"]) == (150, 1, 10.0)


def test_dimension_fan_out_is_kept_and_reported(spark):
    # one product id with two names: the product dimension has two rows for it
    b = bronze(spark, [line("o1", "p1", product_name="A"), line("o2", "p1", product_name="B", sales="60")])
    ds = medallion.build(b)
    assert ds["dim_produto"].count() == 2
    # revenue is counted once per matching dimension row, as the published mart does
    assert ds["vendas_por_categoria"].first()["faturamento_total"] == 2 * (100 + 60)
    rep = star.dim_key_report(ds["dim_produto"], "dim_produto").first()
    assert (rep["dim_rows"], rep["distinct_keys"], rep["duplicated_keys"]) == (2, 1, 1)


def test_pre_aggregated_marts_equal_line_level_joins(spark):
    b = bronze(spark, [
        line(f"o{i % 7}", f"p{i % 5}", customer=f"c{i % 4}", segment=["A", "B"][i % 2],
             sales=str(10 + i), profit=f"{i}.25", shipping=f"{i % 3}.10", margin=f"0,{i % 9}5",
             product_name=["X", "Y"][i % 3 == 0], state=["SP", "RJ"][i % 2])
        for i in range(60)
    ])
    ds = medallion.build(b)
    ft, dp, dl, dc = ds["ft_vendas"], ds["dim_produto"], ds["dim_localizacao"], ds["dim_cliente"]
    from pyspark.sql import functions as F

    naive = ft.join(dp, "product_id").groupBy("category", "sub_category").agg(
        F.sum("sales").alias("faturamento_total"), F.round(F.sum("profit"), 6).alias("lucro_total"),
        F.sum("quantity").alias("qtd_itens_vendidos"), F.round(F.avg("margem_lucro"), 4).alias("margem_media"))
    got = marts.vendas_por_categoria(ft, dp).withColumn("lucro_total", F.round("lucro_total", 6))
    assert rows(got) == rows(naive.select(*got.columns))
    naive = ft.join(dl, ["country", "state"]).groupBy("market", "region", "country").agg(
        F.sum("sales").alias("faturamento_total"), F.count_distinct("order_id").alias("total_pedidos"))
    got = marts.desempenho_regional(ft, dl).select("market", "region", "country", "faturamento_total", "total_pedidos")
    assert rows(got) == rows(naive)
    naive = ft.join(dc, "customer_name").groupBy("segment").agg(
        F.count_distinct("customer_name").alias("total_clientes"), F.sum("sales").alias("faturamento_total"),
        F.round(F.sum("sales") / F.count_distinct("order_id"), 2).alias("ticket_medio_por_pedido"))
    got = marts.metrica_clientes(ft, dc).drop("lucro_total")
    assert rows(got) == rows(naive.select(*got.columns))


def test_enrichment_is_left_join(spark):
    b = bronze(spark, [line("o1", "p1"), line("o2", "p2", customer="zed")])
    ds = medallion.build(b)
    dim_cli = ds["dim_cliente"].filter("customer_name = 'ana'")
    out = enrich_sales(ds["ft_vendas"], dim_cli, ds["dim_localizacao"], ds["dim_produto"])
    got = {r["customer_name"]: r["segment"] for r in out.collect()}
    assert got == {"ana": "Consumer", "zed": None}


def test_enriched_lines_of_a_customer_together(spark):
    """The same rows in either order of the joins; by customer, no customer's lines stand in two partitions."""
    keys = "order_id string, product_id string, country string, state string, customer_name string"
    lines = [(f"O{i}", f"P{i % 7}", "X", "Y", f"C{i % 11}" if i % 13 else None) for i in range(200)]
    ft = spark.createDataFrame(lines, keys)
    cli = spark.createDataFrame([(f"C{i}", s) for i in range(10) for s in ("A", "B")[: 1 + i % 2]], "customer_name string, segment string")
    loc = spark.createDataFrame([("X", "Y", "R", "M")], "country string, state string, region string, market string")
    prod = spark.createDataFrame([(f"P{i}", "n", "c", "s") for i in range(6)], "product_id string, product_name string, category string, sub_category string")
    plain = enrich_sales(ft, cli, loc, prod)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = enrich_sales(ft, cli, F.broadcast(loc), prod, by_customer=True)
        assert own.columns == plain.columns and sorted(map(str, own.collect())) == sorted(map(str, plain.collect()))
        places = own.withColumn("_part", F.spark_partition_id()).groupBy("customer_name").agg(F.count_distinct("_part").alias("n"))
        assert {r.n for r in places.collect()} == {1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
