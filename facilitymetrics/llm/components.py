"""Connected components by alternating star contraction, in O(log n) rounds of joins.

Every round only computes minima by node, with partial sums before the shuffle, and joins
them back to the edges, so a node with very many neighbours is never gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.llm.scratch import written


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none, or no such edge."""
    apart = edges.where("u <> v")
    ends = apart.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        apart.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.max((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the smallest node.

    Self loops, repeated edges and either direction are accepted; null ends are ignored.
    """
    now = written(
        edges.where("u is not null and v is not null").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct(),
        "edges",
    )
    while not _stars(now):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(now.where("u = v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        now = written(small.distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
    return roots.groupBy("node").agg(F.min("root").alias("root"))
