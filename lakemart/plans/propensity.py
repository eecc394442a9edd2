"""End-to-end purchase propensity: features → labels → model → scores → ranking.

Every stage stays a DataFrame; only the fitted trees and a handful of metric
values reach the driver. Frames with several readers (sales, training set,
hold-out predictions) are stored once as Parquet and read from there.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RANKING_EXPORT_COLUMNS, SCRIPT_BANDS, SCRIPT_FEATURES, BandSpec, FeatureSpec, ModelSpec
from ..operators import labels, metrics, model, scoring
from ..operators.features import customer_features_current
from ..session import store
from ..sinks import export_csv, export_csv_file, write_table

# What features and labels read of the sales lines.
SALES_INPUTS = (
    "order_id", "customer_name", "order_date", "sales", "quantity", "discount", "profit", "margem_lucro",
    "category", "sub_category", "product_id", "segment", "market",
)
TRAINING_KEY = ["cutoff", "customer_name"]


@dataclass
class PropensityResult:
    trained: model.TrainedModel
    feature_importance: DataFrame
    ranked: DataFrame
    ranking: DataFrame
    top10: DataFrame
    band_summary: DataFrame
    evaluation: dict[str, DataFrame]
    label_rates: DataFrame


def fit_on_training(training: DataFrame, spec: ModelSpec, cv: bool = True) -> model.TrainedModel:
    trained = model.train(training, spec, TRAINING_KEY, cv=cv)
    # without the columns of the pipeline's stages: four metrics read these rows
    trained.test_predictions = store(trained.test_predictions.select(*training.columns, "score", "prediction"))
    return trained


def warn_censored(sales: DataFrame, cutoffs: DataFrame) -> list[str]:
    """Warn about cutoffs whose label window ends after the last order date.

    Their labels are biased towards 0 (the window is not fully observed). The
    check collects one row per cutoff, a list the caller wrote by hand.
    """
    rows = labels.censored_cutoffs(sales, cutoffs).filter(F.col("censored")).select(
        F.date_format("cutoff", "yyyy-MM-dd").alias("c")
    ).collect()
    late = [r["c"] for r in rows]
    if late:
        warnings.warn(f"label windows of cutoffs {late} run past the last order date", stacklevel=2)
    return late


def evaluate(predictions: DataFrame, label: str) -> dict[str, DataFrame]:
    return {
        "roc_auc": metrics.roc_auc(predictions, label, "score"),
        "brier_score": metrics.brier_score(predictions, label, "score"),
        "classification_report": metrics.classification_report(predictions, label, "prediction"),
        "confusion_matrix": metrics.confusion_matrix(predictions, label, "prediction"),
    }


def run_propensity(
    sales: DataFrame,
    cutoffs: DataFrame,
    spec: ModelSpec = ModelSpec(),
    features: FeatureSpec = SCRIPT_FEATURES,
    bands: BandSpec = SCRIPT_BANDS,
    cv: bool = True,
) -> PropensityResult:
    sales = store(sales.select(*[c for c in SALES_INPUTS if c in sales.columns]))
    warn_censored(sales, cutoffs)
    training = store(labels.training_set(sales, cutoffs, features, spec.label))
    trained = fit_on_training(training, spec, cv)
    importance = model.feature_importance(trained.model, trained.test_predictions, spec)
    current = customer_features_current(sales, features)
    scored = model.score_customers(trained.model, current, spec)
    ranked = scoring.rank_scores(scored, bands=bands)
    export_cols = [c if c != "faixa_propensao" else bands.column for c in RANKING_EXPORT_COLUMNS]
    ranking = ranked.select(*export_cols)
    return PropensityResult(
        trained=trained,
        feature_importance=sales.sparkSession.createDataFrame(importance, "Feature string, Importance double").orderBy(F.col("Importance").desc()),
        ranked=ranked,
        ranking=ranking,
        top10=ranking.filter(F.col("ranking") <= 10),
        band_summary=scoring.band_summary(ranking, bands),
        evaluation=evaluate(trained.test_predictions, spec.label),
        label_rates=labels.label_rate_by_cutoff(training, spec.label),
    )


def publish(
    result: PropensityResult,
    table: str | None = None,
    csv_path: str | None = None,
    table_format: str = "parquet",
    single_file: bool = False,
) -> None:
    """Write the ranked customers to a table and/or a CSV export ordered by rank.

    ``single_file``: ``csv_path`` is one file under one header, as the script's
    export is, instead of a folder of parts.
    """
    if table:
        write_table(result.ranked, table, "Purchase propensity of every customer, ranked", table_format)
    if csv_path:
        (export_csv_file if single_file else export_csv)(result.ranking, csv_path, order_by=["ranking"])
