"""Connected components of a graph given as edges, without any node's neighbours in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _neighbour_minimum(edges: DataFrame) -> DataFrame:
    """Every edge in both directions with the smallest node among the first end and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    near = _neighbour_minimum(edges).filter("v > u")
    return near.select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return linked.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of ``edges`` (columns a, b).

    Alternates large and small stars, so the number of rounds grows with the logarithm of a component's size. Each round is
    written to the shared folder, which also cuts the lineage. Neighbours are only ever reduced to their minimum, combined
    before the shuffle. An empty graph gives no rows; loops and repeated edges change nothing.
    """
    now = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row[0] == 0 or tuple(row) == mark:
            break
        mark = tuple(row)
        now = materialize(_small_star(_large_star(now)), "edges")
    # Now every node but the roots hangs on its root.
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
