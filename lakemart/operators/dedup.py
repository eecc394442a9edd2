"""Deterministic de-duplication by key.

``dropDuplicates(keys)`` keeps an arbitrary row of each key. Here the kept row
is the smallest one in a fixed column order (ascending, NULLs first), so runs
and engines agree.

Plan: rows are counted by a 64-bit hash of their key, the only column that this
shuffle moves. A row whose hash no other row has is alone with its key and passes
through as it is, neither shuffled nor sorted; the hashes met twice or more are
stored, counted and, if there are at most ``MOST_CODES`` of them, broadcast. Only
rows with such a hash go into ``min(struct(other columns))`` by the key itself, so
two keys of one hash stay apart. That aggregate combines before its shuffle, so a
key that holds a third of all rows (for example a NULL key) reaches the reducer as
one row per map task. With more repeated hashes than that, all rows go into the
aggregate: one shuffle of them instead of one for each side of a join.

Only those hashes are stored; with too many of them the survivors are. Otherwise
a reader of the result reads ``df`` twice and shuffles the partial minima of
repeated keys. The count reads ``df`` too, so it should be a table or a stored
frame rather than a costly plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

#: Hashes of repeated keys that are broadcast, 8 bytes each.
MOST_CODES = 2_000_000


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per distinct ``keys`` tuple (NULL equals NULL, as in ``groupBy``).

    ``order`` lists the columns that pick the survivor, compared in that order;
    it defaults to every non-key column in schema order. Columns not in
    ``order`` are carried along from the same row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    carried = [c for c in rest if c not in order]
    coded = df.withColumn("_code", F.xxhash64(*keys))
    counts = coded.groupBy("_code").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = store(counts.filter(F.col("_rows") > 1).select("_code"))
    few = repeated.count() <= MOST_CODES
    doubtful = coded.join(F.broadcast(repeated), "_code", "left_semi") if few else coded
    packed = F.struct(*[F.col(c) for c in order + carried])
    best = doubtful.groupBy(*keys).agg(F.min(packed).alias("_row"))
    best = best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    if not few:
        return store(best)
    single = coded.join(F.broadcast(repeated), "_code", "left_anti").select(*df.columns)
    return single.unionAll(best)
