"""Connected components of a graph given by its edges, as Spark joins.

Alternating large and small stars: every round links the neighbours of a node with the smallest
of them, until each component is a star around its smallest node. Edges stay in tables written
to the workspace; nothing but counts reaches the driver, and nodes with very many edges are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import spread_lookup
from monthmill.workspace import Workspace


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """``node`` and ``component`` (the smallest node reached) for every node of ``edges`` that is
    not the smallest of its component. ``edges`` has two bigint columns ``a`` and ``b``."""

    def ordered(df: DataFrame) -> DataFrame:
        pair = df.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        return pair.distinct()

    current = space.write(ordered(edges), "edges")
    while True:
        n = current.count()
        flawed = current.select(F.col("hi").alias("lo")).join(current, "lo").limit(1).count()
        if not flawed and current.select("hi").distinct().count() == n:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))

        both = space.write(
            current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
                current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            ),
            "both-ways",
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
        least = least.withColumn("m", F.least("u", "m"))
        large = spread_lookup(both, least, ["u"], "degree", 2 * n).filter("v > u")
        large = space.write(large.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large-star")

        least = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("degree"))
        small = spread_lookup(large, least, ["hi"], "degree", large.count())
        pairs = small.select(F.col("lo").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("hi").alias("a"), F.col("m").alias("b"))
        )
        following = space.write(ordered(pairs), "small-star")
        space.drop(current, both, large)
        current = following
