"""Connected components by alternating large and small stars.

Each round links every neighbour to the smallest node known nearby, so chains
shrink to stars in a logarithmic number of rounds. Rounds are stored in the
shared folder, each until the next one is; nothing but a count of edges reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import BROADCAST_KEYS, shuffled, store

#: Neighbours beyond which a node's edges are not brought to one task.
HOT = 500


def _least_neighbours(both: DataFrame) -> DataFrame:
    """``a, m, n``: the smallest of each node and its neighbours, and their number; stored."""
    return store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")))


def _large_star(both: DataFrame, least: DataFrame) -> DataFrame:
    """Edges from the larger neighbours of each node to its smallest.

    Nodes with more than ``HOT`` neighbours, few as they are, are joined by
    broadcast, so that no task gets all edges of one.
    """
    hot = least.filter(F.col("n") > HOT).select("a", "m")
    if 0 < hot.count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
        others = both.join(hot.select("a"), "a", "left_anti").join(shuffled(least.filter(F.col("n") <= HOT).select("a", "m")), "a")
        joined = both.join(hot, "a").unionByName(others)
    else:
        joined = both.join(shuffled(least.select("a", "m")), "a")
    far = joined.filter(F.col("b") > F.col("a"))
    return far.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(shuffled(least), "a")
    linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return linked.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for nodes that an edge ``a, b`` moves.

    Nodes that are the smallest of their component, or have no edge, are left out.
    """
    now = store(edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_neighbours(both)
        large = store(_large_star(both, least))
        after = store(_small_star(large))
        for done in (least, large, now):
            discard(done)
        now = after
