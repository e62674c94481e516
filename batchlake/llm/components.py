"""Connected components by alternating large and small stars, as joins and aggregates.

Edges are rows; no vertex's neighbours are ever gathered in one row, and the join of a
hub with its neighbours is one that Spark can split. Each round is written to the shared
folder, which cuts the lineage. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.llm.base import landed, scratch


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, v, low): every directed edge with the least vertex that u or its neighbours are."""
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return edges.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex in ``edges`` (columns a, b); the root is the least one.

    Loops and repeated edges are allowed; rows with a null end are left out.
    """
    with scratch(edges.sparkSession):
        current = landed(
            edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
        )
        before = None
        while True:
            both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
            hooked = _lowest(large.filter("u > v"))
            small = (
                hooked.select(F.col("v").alias("u"), F.col("low").alias("v"))
                .unionByName(hooked.select("u", F.col("low").alias("v")))
                .filter("u <> v")
                .distinct()
            )
            current = landed(small, "stars")
            now = current.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
            if now == before:
                break
            before = now
        roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        return landed(both, "roots", kept=True)
