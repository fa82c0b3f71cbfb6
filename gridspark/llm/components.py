"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import Run


def _to_least(edges: DataFrame, run: Run, name: str) -> DataFrame:
    """Edges (u, v, m) with the least of u and all its neighbours. A node may hold most edges: the minimum is
    taken before the shuffle, and the join is one that Spark splits where it is skewed."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(run.write(least, name).hint("merge"), "u")
    return joined.withColumn("m", F.least("u", "m"))


def _settled(edges: DataFrame) -> bool:
    """Whether (u, v) is a set of stars: every node is a root or has one root."""
    ends = edges.select("u", F.lit(1).alias("child")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("child")))
    roles = ends.groupBy("u").agg(F.sum("child").alias("children"), F.sum(1 - F.col("child")).alias("roots"))
    return roles.where("children > 1 or (children = 1 and roots > 0)").isEmpty()


def components(links: DataFrame, run: Run, name: str = "components") -> DataFrame:
    """(node, root): every node of ``links`` (a, b) but the roots, with the least node it can reach.

    Each round joins all neighbours above a node to its least neighbour, then all below; the number of
    rounds grows with the logarithm of the graph. Edges stay in tables of the run folder.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, turn = run.write(ordered.distinct(), f"{name}-0"), 0
    while not _settled(edges):
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, run, f"{name}-{turn}-a").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = run.write(large, f"{name}-{turn}-large")
        small = _to_least(large, run, f"{name}-{turn}-b").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = run.write(small.where("u <> v").distinct(), f"{name}-{turn}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
