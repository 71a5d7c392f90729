"""Connected components of links, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinomart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of the links (a, b) with the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers to their ends, and
    contracts the links to those ends, until no link is left. Links and nodes stay in Spark; rounds
    grow with the logarithm of the longest chain.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    roots: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        pointers = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
        while True:
            ends = pointers.select(F.col("node").alias("root"), F.col("root").alias("further"))
            jumps = pointers.join(ends, "root")
            if jumps.where("further != root").isEmpty():
                break
            pointers = stored(jumps.select("node", F.col("further").alias("root")))
        if roots is None:
            roots = pointers
        else:
            step = pointers.select(F.col("node").alias("root"), F.col("root").alias("further"))
            roots = roots.join(step, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
        left = pointers.withColumnRenamed("node", "a").withColumnRenamed("root", "ra")
        right = pointers.withColumnRenamed("node", "b").withColumnRenamed("root", "rb")
        contracted = edges.join(left, "a").join(right, "b").where("ra != rb")
        edges = stored(contracted.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
