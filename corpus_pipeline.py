"""A cleaning pipeline over ``documents``, made of the text operators.

Rejected by the quality classifier, copies, and near copies go; personal data
is masked; what is left is packed into training sequences. Every stage but the
last returns the columns of ``documents``.

Defined cases: see the operators. A null text counts as empty; rows with a null
id are judged by their text, and are never linked to others as near copies; an
empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import cotraining
from lakemart.llm.common import documents, prepare, store
from lakemart.llm.exact_dedup import keep_largest
from lakemart.llm.minhash import keep_one_of_each
from lakemart.llm.pii import mask_pii
from lakemart.llm.queries import packed_documents

#: Similarity, in percent, from which the near-copy stage links two documents; 85 is that of the op5 query only.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = cotraining.learn(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.keep_good(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id goes on."""
    prepare(spark)
    return keep_largest(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies linked at a similarity of 0.8 or more the document with the smallest id goes on."""
    prepare(spark)
    return keep_one_of_each(docs, percent=NEAR_PERCENT)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    prepare(spark)
    return mask_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as token pieces in sequences of 4096."""
    prepare(spark)
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None  # the learned and tokenizing stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs)
    return docs
