"""Named queries over the benchmark tables (``region nation customer … part``).

Every query derives the raw sales lines from the tables (see
``sources.tpch_sales``) and runs a lakehouse step on them, over the whole
tables. Nondeterministic audit columns (ingestion and update times) are left
out of the query results; the library functions keep them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import (
    SALES_COLUMNS,
    NOTEBOOK_BANDS,
    NOTEBOOK_FEATURES,
    NOTEBOOK_NUMERIC_FEATURES,
    RANKING_EXPORT_COLUMNS,
    SCRIPT_BANDS,
    SCRIPT_FEATURES,
    BandSpec,
    Layers,
    ModelSpec,
)
from ..functions.cleaning import clean_columns
from ..operators import features as feat
from ..operators import labels, marts, metrics, model, scoring, star
from ..operators.dedup import dedup_by_key
from ..operators.enrich import enrich_sales
from ..operators.ranking import global_row_number
from ..sources import tpch_sales
from ..schemas import RANKING_SCHEMA, SALES_RAW_SCHEMA
from ..session import bytes_at, new_folder, store
from ..sinks import export_csv, export_csv_file, write_table
from ..sources.raw_sales import bronze_sales, sales_from_silver, tolerant_sales
from . import medallion
from .propensity import SALES_INPUTS, evaluate, fit_on_training, run_propensity

# Test cutoffs inside the tables' 1995-2001 order dates.
TEST_CUTOFFS = ("1996-06-30", "1996-12-31", "1997-06-30", "1997-12-31")
TEST_HORIZON = 90
TEST_SINGLE_CUTOFF = "1999-06-30"
TEST_SINGLE_HORIZON = 180
HISTORY_CUTOFF = "1997-12-31"

AUDIT = ("_ingestion_time", "_updated_at")


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT if c in df.columns])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales lines derived from the tables (lazy)."""
    return tpch_sales.raw_sales(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_lines(spark, sf_dir)
    return raw.select(*SALES_COLUMNS, F.current_timestamp().alias("_ingestion_time"), "_source_file")


def datasets(spark: SparkSession, sf_dir: str) -> medallion.Datasets:
    """The refresh's datasets over stored raw lines, for a query of one dataset of the cleaned view."""
    return medallion.build(store(bronze(spark, sf_dir)))


def shared_datasets(spark: SparkSession, sf_dir: str, *wanted: str) -> medallion.Datasets:
    """The same for queries that need several datasets: what they read of the cleaned view is stored once."""
    return medallion.build(bronze(spark, sf_dir), store_view=True, wanted=wanted)


def script_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standalone script's input: raw lines, tolerant typing, required fields (lazy)."""
    return tolerant_sales(raw_lines(spark, sf_dir))


def feature_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What features and labels read of the script's input; stored, since they read it more than once."""
    return store(script_sales(spark, sf_dir).select(*SALES_INPUTS))


def notebook_sales(spark: SparkSession, sf_dir: str, by_customer: bool = False) -> DataFrame:
    """The notebook's input: the silver fact left-joined with three dimensions."""
    d = shared_datasets(spark, sf_dir, "ft_vendas", "dim_cliente", "dim_localizacao", "dim_produto")
    return enrich_sales(d["ft_vendas"], d["dim_cliente"], d["dim_localizacao"], d["dim_produto"], by_customer)


def sample_cutoffs(spark: SparkSession) -> DataFrame:
    return feat.cutoff_frame(spark, TEST_CUTOFFS, TEST_HORIZON)


def _cutoff_text(df: DataFrame) -> DataFrame:
    return df.withColumn("cutoff", F.date_format("cutoff", "yyyy-MM-dd"))


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.training_set(feature_sales(spark, sf_dir), sample_cutoffs(spark), SCRIPT_FEATURES)


def closed_form_score(customer: DataFrame) -> DataFrame:
    """A fixed score per customer standing in for the model in checkable queries."""
    score = F.round((F.col("c_custkey") * 7919 % 10007).cast("double") / F.lit(10007.0), 4)
    return customer.select(F.col("c_name").alias("customer_name"), score.alias("propensity_score"))


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = feat.customer_features_current(feature_sales(spark, sf_dir), SCRIPT_FEATURES)
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return current.join(closed_form_score(customer), "customer_name", "inner")


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training labels with the fixed customer score and the 0.5-threshold class."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = training(spark, sf_dir).select("cutoff", "customer_name", F.col("target_comprou").alias("label"))
    joined = rows.join(closed_form_score(customer), "customer_name", "inner")
    return metrics.predicted(joined.withColumnRenamed("propensity_score", "score"), "score")


# --- queries -----------------------------------------------------------------


def q_bronze_ingest(spark, sf_dir):
    return _no_audit(bronze(spark, sf_dir))


def q_dedup_sales(spark, sf_dir):
    b = store(_no_audit(bronze(spark, sf_dir)))
    return dedup_by_key(b, ["order_id", "product_id"], [c for c in b.columns if c not in ("order_id", "product_id")])


def q_clean_numeric(spark, sf_dir):
    cleaned = clean_columns(tpch_sales.raw_sales(spark, sf_dir))
    return cleaned.select(
        "order_id", "product_id", "sales", "quantity", "discount", "margem_lucro", "profit", "shipping_cost"
    )


def q_sales_cleaned(spark, sf_dir):
    return _no_audit(datasets(spark, sf_dir)["sales_cleaned_view"])


def q_tolerant_load(spark, sf_dir):
    s = script_sales(spark, sf_dir)
    return s.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd")).drop("_source_file")


def _dataset_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return _no_audit(datasets(spark, sf_dir)[name])

    run.__name__ = f"q_{name}"
    return run


def q_vendas_por_categoria(spark, sf_dir):
    return marts.by_revenue(shared_datasets(spark, sf_dir, "vendas_por_categoria")["vendas_por_categoria"], "category", "sub_category")


def q_desempenho_regional(spark, sf_dir):
    return marts.by_revenue(shared_datasets(spark, sf_dir, "desempenho_regional")["desempenho_regional"], "market", "region", "country")


def q_metrica_clientes(spark, sf_dir):
    return marts.by_revenue(shared_datasets(spark, sf_dir, "metrica_clientes")["metrica_clientes"], "segment")


def q_quality_report(spark, sf_dir):
    return medallion.quality_report(bronze(spark, sf_dir), store_view=True)


def q_conformity_rate(spark, sf_dir):
    return medallion.conformity_report(bronze(spark, sf_dir), store_view=True)


def q_dim_key_uniqueness(spark, sf_dir):
    d = shared_datasets(spark, sf_dir, *star.DIM_COLUMNS)
    parts = [star.dim_key_report(d[n], n) for n in star.DIM_COLUMNS]
    return reduce(DataFrame.unionByName, parts)


def q_enriched_sales(spark, sf_dir):
    return _no_audit(notebook_sales(spark, sf_dir))


def q_history_asof(spark, sf_dir):
    h = feat.history_asof(script_sales(spark, sf_dir), HISTORY_CUTOFF)
    return h.select("order_id", "customer_name", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "sales")


def q_buyers_in_window(spark, sf_dir):
    return _cutoff_text(labels.buyers_in_window(script_sales(spark, sf_dir), sample_cutoffs(spark)))


def q_label_customers(spark, sf_dir):
    return _cutoff_text(training(spark, sf_dir).select("cutoff", "customer_name", "target_comprou"))


def q_customer_features(spark, sf_dir):
    return _cutoff_text(feat.customer_features_asof(feature_sales(spark, sf_dir), sample_cutoffs(spark)))


def q_customer_features_current(spark, sf_dir):
    return feat.customer_features_current(feature_sales(spark, sf_dir))


def q_customer_mode(spark, sf_dir):
    return feat.customer_mode(feature_sales(spark, sf_dir))


def q_sales_profile(spark, sf_dir):
    return feat.sales_profile(script_sales(spark, sf_dir))


def q_multi_window_training(spark, sf_dir):
    return _cutoff_text(training(spark, sf_dir))


def q_single_window_training(spark, sf_dir):
    cutoffs = feat.cutoff_frame(spark, [TEST_SINGLE_CUTOFF], TEST_SINGLE_HORIZON)
    # the notebook's features count no sub-categories and no products
    columns = [c for c in SALES_INPUTS if c not in ("sub_category", "product_id")]
    sales = store(notebook_sales(spark, sf_dir, by_customer=True).select(*columns))
    return _cutoff_text(labels.training_set(sales, cutoffs, NOTEBOOK_FEATURES))


def q_label_rate_by_cutoff(spark, sf_dir):
    return labels.label_rate_by_cutoff(training(spark, sf_dir).select("cutoff", "target_comprou"))


def q_score_deciles(spark, sf_dir):
    s = scoring.add_deciles(store(scored_customers(spark, sf_dir)))
    return s.select("customer_name", "propensity_score", "percentil_score")


def q_propensity_bands(spark, sf_dir):
    s = scoring.add_bands(scored_customers(spark, sf_dir), bands=SCRIPT_BANDS)
    return s.select("customer_name", "propensity_score", SCRIPT_BANDS.column)


def q_propensity_bands_crm(spark, sf_dir):
    s = scoring.add_bands(scored_customers(spark, sf_dir), bands=NOTEBOOK_BANDS)
    return s.select("customer_name", "propensity_score", NOTEBOOK_BANDS.column)


def ranked(spark, sf_dir):
    return scoring.rank_scores(scored_customers(spark, sf_dir), bands=SCRIPT_BANDS)


def q_propensity_ranking(spark, sf_dir):
    return ranked(spark, sf_dir).select(*RANKING_EXPORT_COLUMNS)


def q_top_customers(spark, sf_dir):
    s = scoring.add_bands(scored_customers(spark, sf_dir), bands=SCRIPT_BANDS)
    top = scoring.top_k(s, 10)
    return top.select("ranking", "customer_name", "propensity_score", SCRIPT_BANDS.column, "valor_total_gasto")


def q_band_summary(spark, sf_dir):
    s = scoring.add_bands(scored_customers(spark, sf_dir), bands=SCRIPT_BANDS)
    return scoring.band_summary(s, SCRIPT_BANDS)


def q_roc_auc(spark, sf_dir):
    return metrics.roc_auc(labelled_scores(spark, sf_dir), "label", "score")


def q_brier_score(spark, sf_dir):
    return metrics.brier_score(labelled_scores(spark, sf_dir), "label", "score")


def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(labelled_scores(spark, sf_dir), "label", "prediction")


def q_classification_report(spark, sf_dir):
    return metrics.classification_report(labelled_scores(spark, sf_dir), "label", "prediction")


def q_stratified_split(spark, sf_dir):
    t = store(training(spark, sf_dir).select("cutoff", "customer_name", "target_comprou"))
    split = model.stratified_split(t, "target_comprou", ["cutoff", "customer_name"], 0.2, 5, 42)
    return _cutoff_text(split)


def q_class_weight(spark, sf_dir):
    t = store(training(spark, sf_dir).select("cutoff", "customer_name", "target_comprou"))
    split = model.stratified_split(t, "target_comprou", ["cutoff", "customer_name"], 0.2, 5, 42)
    return model.class_weights(split.filter(F.col("split") == "train"), "target_comprou")


def q_feature_importance(spark, sf_dir):
    """Features of the default model (150 trees); importances differ between learners, their sum does not.

    Cross-validation does not enter into them; the end-to-end queries run it.
    """
    trained = fit_on_training(store(training(spark, sf_dir)), ModelSpec(), cv=False)
    pairs = model.feature_importance(trained.model, trained.test_predictions, ModelSpec())
    frame = spark.createDataFrame(pairs, "Feature string, Importance double")
    total = F.round(F.sum("Importance").over(Window.partitionBy(F.lit(1))), 6)  # one row per model feature
    return frame.select("Feature", (F.col("Importance") >= 0).alias("not_negative"), total.alias("total_importance"))


def _run_checks(result, bands):
    """The run's ranking: what does not depend on the fit as it is, the rest as consistency checks."""
    r = store(result.ranking)
    expected = scoring.add_bands(scoring.add_deciles(r, out="_decile"), bands=BandSpec("_band", bands.high, bands.medium, bands.labels))
    expected = global_row_number(expected, scoring.ranking_order(), "_rank")
    return expected.select(
        "customer_name", "recencia_dias", "frequencia_pedidos", "valor_total_gasto", "ticket_medio", "data_ultima_compra", "segment", "market",
        F.col("propensity_score").between(0, 1).alias("score_in_range"),
        (F.col("ranking") == F.col("_rank")).alias("rank_agrees"),
        F.col("percentil_score").eqNullSafe(F.col("_decile")).alias("decile_agrees"),
        (F.col(bands.column) == F.col("_band")).alias("band_agrees"),
    )


def q_propensity_pipeline(spark, sf_dir):
    """The script's run, end to end, with the default model (150 trees, 5 folds)."""
    return _run_checks(run_propensity(script_sales(spark, sf_dir), sample_cutoffs(spark)), SCRIPT_BANDS)


def q_notebook_ranking(spark, sf_dir):
    """The notebook's run, end to end: silver tables, one cutoff, its features and bands."""
    cutoffs = feat.cutoff_frame(spark, [TEST_SINGLE_CUTOFF], TEST_SINGLE_HORIZON)
    spec = ModelSpec(numeric=NOTEBOOK_NUMERIC_FEATURES)
    result = run_propensity(notebook_sales(spark, sf_dir), cutoffs, spec, NOTEBOOK_FEATURES, NOTEBOOK_BANDS)
    return _run_checks(result, NOTEBOOK_BANDS)


def q_holdout_evaluation(spark, sf_dir):
    """Hold-out report and cross-validation of the script's run, with the default model (150 trees, 5 folds).

    Which rows are held out does not depend on the fit, so their numbers by class
    are exact; figures of the fit come as checks of their range and of each other.
    """
    trained = fit_on_training(store(training(spark, sf_dir)), ModelSpec(), cv=True)
    evaluated = evaluate(trained.test_predictions, ModelSpec().label)
    auc = evaluated["roc_auc"].first()["roc_auc"]
    brier = evaluated["brier_score"].first()["brier_score"]
    cells = evaluated["confusion_matrix"]
    by_class = cells.groupBy("label").agg(F.sum("n").alias("in_matrix"))
    report = evaluated["classification_report"].filter(F.col("classe").isin("0", "1"))
    ratios = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1_score")]
    return report.join(by_class, F.col("classe") == F.col("label").cast("string")).select(
        "classe",
        "support",
        F.col("in_matrix").cast("long").alias("in_matrix"),
        reduce(lambda a, b: a & b, ratios).alias("ratios_in_range"),
        F.lit(0.0 <= auc <= 1.0).alias("auc_in_range"),
        F.lit(0.0 <= brier <= 1.0).alias("brier_in_range"),
        F.lit(0.0 < trained.cv_auc_mean < 1.0 and trained.cv_auc_std < 0.2).alias("folds_agree"),
    )


#: Files that the raw lines are spread over for the CSV queries.
CSV_FILES = 16
#: Bytes of the tables from which each file is sure to get some of the orders.
CSV_BY_ORDER = 8 << 20


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines in a partition for each CSV file.

    Lines go to the files by order, as the join with the orders leaves them: its
    partitions, many to a file, are written one after another, and no shuffle moves
    the texts. Only small tables, whose few orders might leave a file without any,
    are dealt out in turn.
    """
    if bytes_at(spark, tpch_sales.table_paths(sf_dir)) < CSV_BY_ORDER:
        return raw_lines(spark, sf_dir).select(*SALES_COLUMNS).repartition(CSV_FILES)
    return tpch_sales.raw_sales(spark, sf_dir, by_order_in=CSV_FILES).select(*SALES_COLUMNS).coalesce(CSV_FILES)


def csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw lines as CSV files with a header in the shared folder."""
    folder = new_folder(spark, "csv")
    export_csv(csv_lines(spark, sf_dir), folder)
    return folder


def q_csv_bronze(spark, sf_dir):
    """Bronze from CSV files: every text as it was written, the files it came from, one ingestion time."""
    scanned = bronze_sales(spark, csv_files(spark, sf_dir), SALES_RAW_SCHEMA)
    audit = scanned.agg(
        F.count_distinct("_source_file").alias("n_files"),
        F.count_distinct("_ingestion_time").alias("n_times"),
        F.min(F.col("_source_file").endswith(".csv")).alias("files_named"),
    )
    return scanned.select(*SALES_COLUMNS).crossJoin(F.broadcast(audit))  # one row


def q_csv_fallback(spark, sf_dir):
    """The notebook's input where the silver tables are missing: the CSV files, typed tolerantly."""
    missing = f"none_{uuid.uuid4().hex}"
    sales = sales_from_silver(spark, missing, csv_files(spark, sf_dir))
    return sales.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


def refreshed(spark: SparkSession, sf_dir: str) -> tuple[Layers, DataFrame]:
    """A full refresh into a catalog of its own, in the shared folder; its layers and rule counts."""
    own = uuid.uuid4().hex[:12]
    layers = Layers(*(f"lakemart_{own}_{layer}" for layer in ("bronze", "silver", "gold")))
    for name in (layers.bronze, layers.silver, layers.gold):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    return layers, medallion.run(spark, bronze(spark, sf_dir), layers)


def q_catalog_refresh(spark, sf_dir):
    """Every table of a refresh as the catalog has it: columns in order, types, comment, rows."""
    layers, _ = refreshed(spark, sf_dir)
    rows, counts = [], []
    for d in medallion.DATASETS:
        if d.layer == "view":
            continue
        name = medallion.table_name(layers, d)
        comment = spark.catalog.getTable(name).description
        rows += [(d.name, i, c.name, c.dataType, comment) for i, c in enumerate(spark.catalog.listColumns(name))]
        counts.append(spark.read.table(name).agg(F.lit(d.name).alias("dataset"), F.count(F.lit(1)).alias("n_rows")))
    columns = spark.createDataFrame(rows, "dataset string, position int, column_name string, data_type string, comment string")
    return columns.join(reduce(DataFrame.unionByName, counts), "dataset")


def q_catalog_rules(spark, sf_dir):
    """Rule counts that a refresh takes while it writes its tables."""
    return refreshed(spark, sf_dir)[1]


def q_silver_sales(spark, sf_dir):
    """The notebook's input read back from the silver tables."""
    layers, _ = refreshed(spark, sf_dir)
    return _no_audit(sales_from_silver(spark, layers.silver))


def q_table_replaced(spark, sf_dir):
    """A table after an overwrite with another schema, made from the table itself, and a failed one."""
    own = f"lakemart_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {own} LOCATION '{new_folder(spark, own)}'")
    name = f"{own}.customers"
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    write_table(customer, name, "first")
    old = spark.read.table(name)
    write_table(old.select(F.col("c_custkey").cast("string").alias("key"), "c_mktsegment", (F.col("c_custkey") % 7).alias("rest")), name, "it's second")
    broken = spark.read.table(name).select(F.when(F.col("rest") == 3, F.raise_error(F.lit("stop"))).otherwise(F.lit(1)).alias("x"))
    failed = False
    try:
        write_table(broken, name, "third")
    except Exception:  # whatever stops the job: the old table must be there
        failed = True
    left = [t.name for t in spark.catalog.listTables(own) if not t.isTemporary]
    comment = spark.catalog.getTable(name).description
    return spark.read.table(name).withColumns({"comment": F.lit(comment), "failed": F.lit(failed), "tables": F.lit(len(left))})


def q_features_without_optional(spark, sf_dir):
    """Current features of lines that lack the optional columns: defaults stand in."""
    sales = feature_sales(spark, sf_dir).drop("category", "sub_category", "product_id", "segment", "market")
    return feat.customer_features_current(sales, NOTEBOOK_FEATURES)


def q_ranking_file(spark, sf_dir):
    """The ranking exported as one CSV file and read back; ``in_order``: its lines stand by rank."""
    path = f"{new_folder(spark, 'export')}/ranking.csv"
    export_csv_file(ranked(spark, sf_dir).select(*RANKING_EXPORT_COLUMNS), path, ["ranking"])
    read = spark.read.schema(RANKING_SCHEMA).option("header", "true").option("enforceSchema", "false").csv(path)
    # lines of one split are numbered one after another, so their ranks are a constant ahead
    placed = read.withColumn("_ahead", F.col("ranking") - F.monotonically_increasing_id())
    by_split = placed.groupBy(F.spark_partition_id()).agg((F.min("_ahead") == F.max("_ahead")).alias("same"))
    return read.crossJoin(F.broadcast(by_split.agg(F.min("same").alias("in_order"))))  # one row


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_ingest": q_bronze_ingest,
    "dedup_sales": q_dedup_sales,
    "clean_numeric": q_clean_numeric,
    "sales_cleaned": q_sales_cleaned,
    "tolerant_load": q_tolerant_load,
    "dim_produto": _dataset_query("dim_produto"),
    "dim_cliente": _dataset_query("dim_cliente"),
    "dim_localizacao": _dataset_query("dim_localizacao"),
    "dim_modo_envio": _dataset_query("dim_modo_envio"),
    "ft_vendas": _dataset_query("ft_vendas"),
    "vendas_por_categoria": q_vendas_por_categoria,
    "desempenho_regional": q_desempenho_regional,
    "metrica_clientes": q_metrica_clientes,
    "quality_report": q_quality_report,
    "conformity_rate": q_conformity_rate,
    "dim_key_uniqueness": q_dim_key_uniqueness,
    "enriched_sales": q_enriched_sales,
    "history_asof": q_history_asof,
    "buyers_in_window": q_buyers_in_window,
    "label_customers": q_label_customers,
    "customer_features": q_customer_features,
    "customer_features_current": q_customer_features_current,
    "customer_mode": q_customer_mode,
    "sales_profile": q_sales_profile,
    "multi_window_training": q_multi_window_training,
    "single_window_training": q_single_window_training,
    "label_rate_by_cutoff": q_label_rate_by_cutoff,
    "score_deciles": q_score_deciles,
    "propensity_bands": q_propensity_bands,
    "propensity_bands_crm": q_propensity_bands_crm,
    "propensity_ranking": q_propensity_ranking,
    "top_customers": q_top_customers,
    "band_summary": q_band_summary,
    "roc_auc": q_roc_auc,
    "brier_score": q_brier_score,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "stratified_split": q_stratified_split,
    "class_weight": q_class_weight,
    "feature_importance": q_feature_importance,
    "propensity_pipeline": q_propensity_pipeline,
    "notebook_ranking": q_notebook_ranking,
    "holdout_evaluation": q_holdout_evaluation,
    "csv_bronze": q_csv_bronze,
    "csv_fallback": q_csv_fallback,
    "catalog_refresh": q_catalog_refresh,
    "catalog_rules": q_catalog_rules,
    "silver_sales": q_silver_sales,
    "table_replaced": q_table_replaced,
    "features_without_optional": q_features_without_optional,
    "ranking_file": q_ranking_file,
}
