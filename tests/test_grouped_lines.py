"""Groups of lines that several datasets of the quality report share."""

from __future__ import annotations

from lakemart.functions.cleaning import clean_columns
from lakemart.operators import marts
from lakemart.plans import medallion
from tests.conftest import rows


def sample(spark):
    base = {"ship_mode": "m", "order_priority": "1", "order_date": "2020-01-01", "ship_date": "2020-01-02",
            "discount": "0.1", "margem_lucro": "0.2", "shipping_cost": "1", "region": "r", "market": "k",
            "category": "a", "sub_category": "b"}
    lines = [
        base | {"order_id": f"o{i % 7}" if i % 11 else None, "product_id": f"p{i % 5}" if i % 13 else None, "product_name": f"n{i % 3}",
                "customer_name": f"c{i % 4}" if i % 9 else None, "segment": f"s{i % 2}", "country": f"x{i % 3}" if i % 8 else None, "state": f"y{i % 2}",
                "sales": str(i - 10), "quantity": str(i % 6), "profit": f"{i}.25"}
        for i in range(60)
    ]
    return clean_columns(spark.createDataFrame([tuple(x[c] for c in sorted(x)) for x in lines], ", ".join(f"{c} string" for c in sorted(lines[0]))))


def test_groups_shared_by_datasets_give_each_of_them(spark):
    """Dimensions and marts read from shared groups equal those built of the lines; a line stands in one group of each family."""
    cleaned = sample(spark)
    fact = medallion.apply_expectations(cleaned, medallion.rules_for("ft_vendas"))
    names = [*medallion.DIMS, *marts.KPIS]
    grouped = medallion.grouped_lines(cleaned, names).cache()
    assert grouped.select("dataset").distinct().count() == 3
    for name in medallion.DIMS:
        expected = rows(cleaned.select(*medallion.DIM_COLUMNS[name]).distinct())
        assert rows(medallion.dimension_of(grouped, name, names)) == expected
        alone = medallion.grouped_lines(cleaned, [name])
        assert rows(medallion.dimension_of(alone, name, [name])) == expected
    for name, kpis in marts.KPIS.items():
        (dim,) = (i for i in medallion.BY_NAME[name].inputs if i in medallion.DIM_COLUMNS)
        dimension = cleaned.select(*medallion.DIM_COLUMNS[dim]).distinct()
        assert rows(kpis(medallion.groups_of(grouped, name, names), dimension)) == rows(kpis(marts.pre_aggregated(fact, name), dimension))
