"""Connected components by alternating large and small stars, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import cut, gathered


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each end of the edges ``a, b``.

    Nodes may be of any ordered type.  Self-loops and edges with a null end are ignored, so a
    node without other edges is not in the result.  Each round rewires every node to the
    smallest neighbour it knows; the number of rounds grows with the logarithm of the
    component size.  Minima are combined before the shuffle, and the join with them is one
    that adaptive execution splits where a hub holds most edges.  A round has as many tasks
    as its edges are worth.
    """
    now = cut(_ordered(edges).distinct())
    seen = _mark(now)
    while True:
        rows = seen[0]
        now = gathered(now, rows)
        now = cut(gathered(_small_star(gathered(_large_star(now, rows), rows), rows), rows))
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    stars = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges with their smaller end as ``a``."""
    return edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets."""
    folded = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), folded).first())


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Join larger neighbours of each node to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return gathered(joined, rows).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Join smaller neighbours of each node, and the node, to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    kept = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return gathered(_ordered(moved.unionByName(kept).toDF("a", "b")), rows).distinct()
