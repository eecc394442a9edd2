"""Registered queries against their DuckDB oracle on the smallest tables, and the entry contract."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# A representative, fast subset; tools/oracle_check.py runs all of them.
CHECKED = (
    "bronze_ingest", "dedup_sales", "sales_cleaned", "tolerant_load", "dim_produto", "ft_vendas",
    "vendas_por_categoria", "desempenho_regional", "metrica_clientes", "quality_report",
    "conformity_rate", "customer_features", "multi_window_training", "single_window_training",
    "label_rate_by_cutoff", "score_deciles", "propensity_ranking", "band_summary", "roc_auc",
    "classification_report", "stratified_split", "csv_bronze", "csv_fallback", "catalog_refresh", "catalog_rules",
    "silver_sales", "table_replaced", "features_without_optional", "ranking_file",
)

needs_data = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as se

    sdf = se.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(_norm(x) for x in r) for r in srows), key=key)
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in drows), key=key)
    assert len(got) == len(exp)
    assert got == exp


@needs_data
def test_expected_counts_of_the_mapping(spark):
    """FIXTURES F5: counts of the dirty mapping at sf0.001."""
    from lakemart.plans import table_queries as tt

    ds = tt.datasets(spark, SF_SMALL)
    assert ds["sales_cleaned_view"].count() == 5942
    assert ds["ft_vendas"].count() == 5569
    assert ds["dim_produto"].count() == 386
    assert ds["ft_vendas"].agg({"sales": "sum"}).first()[0] == 295467505


@needs_data
def test_entry_and_registry(spark):
    import __spark_entry__ as se

    df = se.entry(spark)
    assert df.columns == ["segment", "total_clientes", "faturamento_total", "lucro_total", "ticket_medio_por_pedido"]
    assert df.count() > 0
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in set(q) - set(o) if n != "pipeline" and not n.startswith("op")}
    assert own == set()


@pytest.mark.parametrize("missing", ["lakemart.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_entry_without_the_text_operators(missing):
    """The folders, or a package they need, can be missing: the other queries are registered."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys, warnings; warnings.simplefilter('ignore')\n"
        f"sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as se\n"
        "print(len(se.queries()), len(se.oracle_sql()), any(n.startswith('op') for n in se.queries()))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert out[0] == out[1] and int(out[0]) >= 51 and out[2] == "False"
