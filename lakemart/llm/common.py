"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import store

__all__ = ["BATCH_ROWS", "BROADCAST_KEYS", "Numbers", "documents", "fresh", "prepare", "shuffled", "slices", "store", "texts_of"]

#: Rows, and bytes, that Spark hands to Python at once. Texts can be long, so batches are kept small.
BATCH_ROWS = 512
BATCH_BYTES = "8m"
#: Keys that may be broadcast; beyond this the same join shuffles.
BROADCAST_KEYS = 1_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Set the Arrow batch sizes that the operators' memory bounds assume.

    Spark reads them when a plan runs, after the query has been handed over, so
    they stay set for the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column in ``taken`` has it (names ignore case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, whose join is to shuffle and merge both sides, however small Spark takes them to be.

    Spark sizes what a table's files hold; rows that an explode or a Python step
    makes of them count as no more. A side of millions of rows can thus be broadcast,
    which the driver's memory does not stand. Only sides that were counted are to be
    broadcast here, by ``F.broadcast``.
    """
    return df.hint("merge")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


class Numbers(dict):
    """Numbers of keys in the order in which they are first asked for; ``values[number]`` is for the caller to fill.

    A full cache becomes the elder of two generations, whose values come back
    when they are asked for: the words of every text stay, those met once go.
    """

    def __init__(self, most: int):
        self.most = most
        self.values: list = []  # by number, in place of dict's method
        self.elder: dict[str, int] = {}
        self.elder_values: list = []
        self.new: list[str] = []

    def turn(self) -> None:
        """Start a generation if this one is full."""
        if len(self) > self.most:
            self.elder, self.elder_values = dict(self), self.values
            self.clear()
            self.values = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        before = self.elder.get(key)
        if before is None:
            self.new.append(key)
            self.values.append(None)
        else:
            self.values.append(self.elder_values[before])
        return number

    def taken(self) -> list[str]:
        """Keys asked for that no generation knew, since the last call."""
        new, self.new = self.new, []
        return new
