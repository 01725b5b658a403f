"""Connected components of an edge table by alternating large and small stars.

Each round replaces a node's edges by edges to the smallest neighbour; rounds
grow with the logarithm of the longest chain. Every round is a written table in
the shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.sources.staging import stage


def _towards_least(arcs: DataFrame) -> DataFrame:
    """(n, v, m): arcs with the smallest of each node and its neighbours."""
    least = arcs.groupBy("n").agg(F.min("v").alias("m")).select("n", F.least("n", "m").alias("m"))
    return arcs.join(least, "n")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("n", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the component's smallest node.

    Self edges, repeated edges and edges in both directions are allowed; a null
    end drops the edge. No edges give no rows.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("n"), F.least(a, b).alias("v"))
    edges = stage(edges.distinct(), "edges")
    before = None
    now = _state(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("n"), F.col("n").alias("v")))
        large = _towards_least(both).where("v > n").select(F.col("v").alias("n"), F.col("m").alias("v")).distinct()
        small = _towards_least(large)
        small = small.where("v <> m").select(F.col("v").alias("n"), F.col("m").alias("v")).unionByName(
            small.select("n", F.col("m").alias("v")))
        edges = stage(small.distinct(), "edges")
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("n").alias("node"), F.col("v").alias("root")).unionByName(roots)
