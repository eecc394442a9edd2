"""Customer features, purchase labels and the training set, against pandas."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakemart.config import NOTEBOOK_FEATURES
from lakemart.operators import features as feat
from lakemart.operators import labels

SCHEMA = (
    "order_id string, customer_name string, order_date date, sales double, quantity double, "
    "discount double, profit double, margem_lucro double, category string, sub_category string, "
    "product_id string, segment string, market string"
)


def sales_frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def d(s):
    return dt.date.fromisoformat(s)


def test_nulls_in_groups(spark):
    data = [
        # customer with all-NULL segment and discount, tied market mode (smallest wins)
        ("o1", "ana", d("2020-01-01"), 10.0, 1.0, None, 1.0, 0.1, "A", "a", "p1", None, "Z"),
        ("o2", "ana", d("2020-01-05"), 20.0, 2.0, None, 2.0, 0.2, "B", "a", "p2", None, "Y"),
        # a line without an order id still counts in sums, not in orders
        (None, "bob", d("2020-01-02"), 5.0, 1.0, 0.5, 0.5, None, "A", "b", "p1", "S1", "M"),
        ("o3", "bob", d("2020-01-03"), 7.0, None, 0.25, None, None, "A", "b", "p1", "S2", "M"),
        ("o4", "bob", d("2020-01-04"), 9.0, 1.0, None, 1.0, None, "A", "b", "p1", "S2", "M"),
        # a line without customer is ignored
        ("o5", None, d("2020-01-09"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p1", "S", "M"),
    ]
    out = {r["customer_name"]: r for r in feat.customer_features_current(sales_frame(spark, data)).collect()}
    assert set(out) == {"ana", "bob"}
    ana, bob = out["ana"], out["bob"]
    assert ana["segment"] == "Unknown" and ana["market"] == "Y"
    assert ana["desconto_medio"] is None
    assert ana["recencia_dias"] == 4  # reference date is the latest order date of all lines
    assert ana["frequencia_pedidos"] == 2 and ana["ticket_medio"] == 15.0
    assert ana["tempo_relacionamento_dias"] == 4
    assert (ana["data_primeira_compra"], ana["data_ultima_compra"]) == ("2020-01-01", "2020-01-05")
    assert bob["frequencia_pedidos"] == 2 and bob["valor_total_gasto"] == 21.0
    assert bob["quantidade_itens"] == 2.0 and bob["segment"] == "S2"
    assert bob["desconto_medio"] == 0.375 and bob["margem_media"] is None
    assert bob["qtd_produtos_distintos"] == 1


def test_notebook_variant_columns_and_defaults(spark):
    data = [("o1", "ana", d("2020-01-01"), 10.0, 1.0, 0.1, 1.0, 0.1, "A", "a", "p1", "S", "M")]
    df = sales_frame(spark, data).drop("segment", "market", "category")
    out = feat.customer_features_current(df, NOTEBOOK_FEATURES)
    assert out.columns == list(feat.FEATURE_COLUMNS_NOTEBOOK)
    r = out.first()
    assert (r["segment"], r["market"], r["qtd_categorias_distintas"]) == ("Consumer", "Global", 1)


def test_window_edges_and_labels(spark):
    cutoff = "2020-03-31"
    data = [
        ("o1", "on_cutoff", d(cutoff), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),
        ("o2", "buys_at_n", d("2020-02-01"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),
        ("o3", "buys_at_n", d("2020-06-29"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),  # cutoff + 90
        ("o4", "buys_after", d("2020-02-01"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),
        ("o5", "buys_after", d("2020-06-30"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),  # cutoff + 91
        ("o6", "future_only", d("2020-04-10"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),
    ]
    cutoffs = feat.cutoff_frame(spark, [cutoff], 90)
    t = labels.training_set(sales_frame(spark, data), cutoffs)
    got = {r["customer_name"]: (r["target_comprou"], r["recencia_dias"]) for r in t.collect()}
    # history is inclusive of the cutoff day; the label window is (cutoff, cutoff + 90]
    assert got == {"on_cutoff": (0, 0), "buys_at_n": (1, 59), "buys_after": (0, 59)}
    rates = {r["cutoff"]: (r["total_clientes"], r["compraram"], r["taxa_compra_pct"])
             for r in labels.label_rate_by_cutoff(t).collect()}
    assert rates == {"2020-03-31": (3, 1, 33.3), None: (3, 1, 33.3)}
    # the data runs to cutoff + 91: the 90-day window is fully observed
    assert labels.censored_cutoffs(sales_frame(spark, data), cutoffs).first()["censored"] is False
    late = feat.cutoff_frame(spark, ["2020-05-31"], 90)
    assert labels.censored_cutoffs(sales_frame(spark, data), late).first()["censored"] is True


def _pandas_features(pdf, ref):
    """The reference's per-customer loop, for comparison."""
    out = []
    for customer, g in pdf.groupby("customer_name"):
        last, first = g["order_date"].max(), g["order_date"].min()
        freq = g["order_id"].nunique()
        value = g["sales"].sum()
        out.append(dict(
            customer_name=customer,
            recencia_dias=(ref - last).days,
            frequencia_pedidos=freq,
            valor_total_gasto=round(value, 2),
            ticket_medio=round(value / freq if freq > 0 else 0.0, 2),
            lucro_total=round(g["profit"].sum(), 2),
            desconto_medio=round(g["discount"].mean(), 4),
            qtd_categorias_distintas=g["category"].nunique(),
            segment=g["segment"].mode()[0],
            tempo_relacionamento_dias=(last - first).days,
        ))
    return pd.DataFrame(out).set_index("customer_name")


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_pandas_loop(spark, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(400):
        data.append((
            f"o{rnd.randint(1, 120)}", f"c{rnd.randint(1, 25)}", d("2020-01-01") + dt.timedelta(days=rnd.randint(0, 300)),
            round(rnd.uniform(1, 500), 2), float(rnd.randint(1, 5)), float(rnd.choice([0.0, 0.05, 0.1, 0.15])),
            round(rnd.uniform(-20, 80), 2), 0.1, rnd.choice("ABC"), rnd.choice("xyz"), f"p{rnd.randint(1, 9)}",
            rnd.choice(["S1", "S2", "S3"]), rnd.choice(["M1", "M2"]),
        ))
    df = sales_frame(spark, data)
    cutoff = "2020-08-31"
    cutoffs = feat.cutoff_frame(spark, [cutoff], 90)
    got = feat.customer_features_asof(df, cutoffs).toPandas().set_index("customer_name")
    pdf = pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    pdf["order_date"] = pd.to_datetime(pdf["order_date"])
    hist = pdf[pdf["order_date"] <= pd.Timestamp(cutoff)]
    exp = _pandas_features(hist, pd.Timestamp(cutoff))
    assert sorted(got.index) == sorted(exp.index)
    for col in exp.columns:
        a, b = got.loc[exp.index, col].to_numpy(), exp[col].to_numpy()
        if a.dtype.kind in "fi" and b.dtype.kind in "fi":
            np.testing.assert_allclose(a.astype(float), b.astype(float), rtol=0, atol=1e-9, err_msg=col)
        else:
            assert list(a) == list(b), col


def test_multi_cutoff_is_one_aggregate(spark):
    data = [(f"o{i}", f"c{i % 3}", d("2020-01-01") + dt.timedelta(days=10 * i), 1.0, 1.0, 0.0, 0.0, 0.0,
             "A", "a", "p", "S", "M") for i in range(30)]
    cutoffs = feat.cutoff_frame(spark, ["2020-02-15", "2020-05-15", "2020-08-15"], 90)
    t = labels.training_set(sales_frame(spark, data), cutoffs)
    per_cutoff = {r["cutoff"]: r["count"] for r in t.groupBy("cutoff").count().collect()}
    assert list(per_cutoff.values()) == [3, 3, 3]


def test_ten_thousand_cutoffs_without_a_theta_join(spark):
    first = d("1990-01-01")
    days = [first + dt.timedelta(days=i) for i in range(10_001)]
    data = [("o1", "a", days[3], 2.0, 1.0, 0.0, 1.0, 0.1, "A", "a", "p", "S", "M"),
            ("o2", "a", days[9_000], 3.0, 1.0, 0.0, 1.0, 0.1, "B", "a", "q", "T", "M"),
            ("o3", "a", days[9_500], 3.0, 1.0, 0.0, 1.0, 0.1, "B", "a", "q", "T", "M"),
            ("o4", "b", days[-1] + dt.timedelta(days=5), 1.0, 1.0, 0.0, 1.0, 0.1, "A", "a", "p", "S", "M")]
    t = labels.training_set(sales_frame(spark, data), feat.cutoff_frame(spark, days, 10))
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert "horizon_days" in plan
    rows = {r["cutoff"]: r for r in t.collect()}
    assert len(rows) == 10_001 - 3  # every cutoff from the first order on; b has no history at any
    last = rows[days[-1]]
    assert (last["frequencia_pedidos"], last["valor_total_gasto"], last["segment"], last["qtd_produtos_distintos"]) == (3, 8.0, "T", 2)
    assert rows[days[8_999]]["target_comprou"] == 1 and rows[days[8_989]]["target_comprou"] == 0
    assert rows[days[9_200]]["segment"] == "S"  # a tie goes to the smallest value


def test_tiny_and_infinite_values_are_summed(spark):
    tiny = [(f"o{i}", "ana", d("2020-01-01"), 4e-7, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M") for i in range(30_000)]
    wide = [("x1", "bob", d("2020-01-01"), 1.0, 1.0, 0.0, float("inf"), 0.0, "A", "a", "p", "S", "M"),
            ("x2", "bob", d("2020-01-01"), 1.0, 1.0, 0.0, 1.0, 0.0, "A", "a", "p", "S", "M")]
    sales = sales_frame(spark, tiny + wide)
    for frame in (feat.customer_features_current(sales), feat.customer_features_asof(sales, feat.cutoff_frame(spark, ["2020-02-01"]))):
        out = {r["customer_name"]: r for r in frame.collect()}
        assert out["ana"]["valor_total_gasto"] == 0.01
        assert out["bob"]["lucro_total"] == float("inf")


def test_not_a_number_and_missing_tokens(spark):
    from lakemart.sources.raw_sales import tolerant_sales

    raw = spark.createDataFrame(
        [("o1", "ana", "2020-01-01", "1", "NaN", "0.10", "1", "0.2"), ("o2", "ana", "2020-01-01", "1", "2", "nan", "NULL", "0.2"),
         ("o3", "NA", "2020-01-01", "1", "2", "0.1", "1", "0.2"), ("n/a", "ana", "2020-01-01", "1", "2", "0.1", "1", "0.2")],
        "order_id string, customer_name string, order_date string, sales string, quantity string, discount string, profit string, margem_lucro string")
    sales = tolerant_sales(raw)
    assert sorted(r["order_id"] for r in sales.collect()) == ["o1", "o2"]
    row = feat.customer_features_current(sales).first()
    assert (row["quantidade_itens"], row["desconto_medio"], row["margem_media"], row["lucro_total"]) == (2.0, 0.1, 0.2, 1.0)


def test_propensity_run_warns_about_censored_cutoffs(spark):
    from lakemart.plans.propensity import warn_censored

    data = [("o1", "a", d("2020-01-01"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M"),
            ("o2", "a", d("2020-03-01"), 1.0, 1.0, 0.0, 0.0, 0.0, "A", "a", "p", "S", "M")]
    cutoffs = feat.cutoff_frame(spark, ["2020-01-15", "2020-02-15"], 30)
    with pytest.warns(UserWarning, match="2020-02-15"):
        assert warn_censored(sales_frame(spark, data), cutoffs) == ["2020-02-15"]


def test_distinct_counts_of_few_and_many_lines(spark, monkeypatch):
    """Customers above and below MANY_LINES alike; NULL values do not count; no row is made of each line and column in one aggregate."""
    rows = [("a", f"O{i % 3}", f"C{i % 2}", None, f"P{i}") for i in range(7)]
    rows += [("b", "O1", None, "S", "P1"), ("b", "O1", None, "S", "P2"), ("c", None, None, None, None), (None, "O9", "C9", "S9", "P9")]
    names = "customer_name string, order_id string, category string, sub_category string, product_id string"
    fixed = {"order_date": F.lit("2020-01-01").cast("date"), "sales": F.lit(1.0), "profit": F.lit(0.5), "discount": F.lit(0.0), "margem_lucro": F.lit(0.1), "quantity": F.lit(1)}
    sales = spark.createDataFrame(rows, names).withColumns(fixed)
    columns = ("frequencia_pedidos", "qtd_categorias_distintas", "qtd_subcategorias_distintas", "qtd_produtos_distintos")
    for most in (0, 2, 5, 100_000):
        monkeypatch.setattr(feat, "MANY_LINES", most)
        out = feat.customer_features_current(sales)
        got = {r.customer_name: tuple(r[c] for c in columns) for r in out.collect()}
        assert got == {"a": (3, 2, 0, 7), "b": (1, 0, 1, 2), "c": (0, 0, 0, 0)}
        assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
