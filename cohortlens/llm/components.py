"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _settled(edges: DataFrame) -> bool:
    """Do the edges only join members to roots: every upper node has one lower one, which is no upper node?"""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(edges.select("lo", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return per_node.agg(F.coalesce(F.bool_and((F.col("up") + F.col("low")) <= 1), F.lit(True))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another one; root is the least node of the component.

    Each step links the neighbours of a node to the least one of them, so depth shrinks geometrically; a
    node with very many neighbours is a partial aggregate and a skew-splittable join, never one group
    in a task. Every step is a written table, so a lost executor repeats one step at most. Edges that already join
    members to the least node of their component need no step.
    """
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct()
    e = cut_lineage(e, "edges")
    while not _settled(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo"), F.col("hi")))
        # both minima are written, so that both sides of a join are plain shuffles and a hub's neighbours can be split
        least = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        low = cut_lineage(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
        pairs = large.join(low, "hi").select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                                                               F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("p"))
        e = cut_lineage(pairs.select("p.hi", "p.lo").filter("hi <> lo").distinct(), "edges")
    roots = e.select(F.col("lo").alias("node")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("node", F.col("node").alias("root")))
