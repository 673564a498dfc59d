"""Connected components of a graph held in a DataFrame.

Large-star and small-star steps in turn: every node's larger neighbours, then its
smaller ones, are linked to the smallest node known among them. The edges become
stars around the smallest node of each component after a number of rounds that grows
with the logarithm of the graph. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialise


def _linked(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over ``edges`` (``a`` > ``b``)."""
    if larger:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = around.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = edges.join(least, F.col("a") == F.col("u"))
        out = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                              F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``node`` and ``component`` (its smallest node) for every node with a link to another.

    Links have no direction; repeated ones, links of a node to itself and links
    with a null end make no difference. Nodes are of any type with an order.
    """
    first, second = F.col(f"`{a}`"), F.col(f"`{b}`")
    edges = materialise(links.where(first != second).select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct(), "edges")
    state = None
    while True:
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct())
        state = (found.n, found.h)
        edges = materialise(_linked(_linked(edges, True), False), "edges")
