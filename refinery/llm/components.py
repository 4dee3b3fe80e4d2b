"""Connected components as DataFrame steps: distributed union-find by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.tables import stored


def _ended(edges: DataFrame) -> bool:
    """Whether every node has one edge at most, to a node without any: then each component is a star around its smallest node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
    return open_.count() == 0


def _least(edges: DataFrame, least) -> DataFrame:
    # Stored, so that the join below is one of two plain tables and Spark can split a node with very many edges.
    return stored(edges.groupBy("u").agg(least.alias("least")).withColumnRenamed("u", "of"), "least")


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(least, F.col("u") == F.col("of"))
    return tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    tied = edges.join(least, F.col("u") == F.col("of")).filter(F.col("v") != F.col("least"))
    return tied.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
        least.select(F.col("of").alias("u"), F.col("least").alias("v"))
    ).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every linked node but the smallest of each component.

    ``links`` has two bigint columns, one row per link, in any direction, repeated or not. The steps end when each
    component is a star, after about log(longest path) of them. No rows give no rows; a link of a node to itself says nothing.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = stored(edges, "links")
    while not _ended(edges):
        least = _least(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), F.least(F.min("v"), F.first("u")))
        large = stored(_large_star(edges, least), "large", [edges, least])
        least = _least(large, F.min("v"))
        edges = stored(_small_star(large, least), "small", [large, least])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
