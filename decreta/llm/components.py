"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node, so a hub is combined on the map
side and its rows can be split; no node's neighbours are collected. The tables of a step
are written to the shared folder, which cuts the lineage. Edges never become more than
twice the links, and the number of steps grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decreta.session import staged


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.min(other).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b`` long): the smallest
    node that its links reach. Nodes without a link to another are not returned."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    before = _mark(edges)
    while before["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _least(both, "a", "b").withColumn("low", F.least("a", "low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = _least(large, "a", "b")
        moved = large.join(low, "a").selectExpr(
            "explode(array(struct(a AS x, low AS y), struct(b AS x, low AS y))) AS e").selectExpr("e.x AS a", "e.y AS b")
        edges = staged(moved.filter("a <> b").distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
