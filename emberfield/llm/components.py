"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved


def _is_star_forest(edges: DataFrame) -> bool:
    """Every larger end points to one smaller end, and no smaller end points on."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if several.limit(1).count():
        return False
    return not edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps: each node's neighbours are linked to the
    smallest of them. Both are an aggregation and an equi-join on the node, never a
    collected neighbour list; the tables are written between steps, so a node with
    a third of all edges is split by the skew join. Self-loops and nulls are ignored.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_star_forest(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "stars")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = saved(large, "edges")
        low = saved(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        e = saved(small.select("x.u", "x.v").where("u > v").distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
