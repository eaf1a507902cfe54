"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _rewired(edges: DataFrame, large: bool) -> DataFrame:
    """Link every larger neighbour (large), or every smaller one and the node itself (small), to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u").where((F.col("v") > F.col("u")) if large else F.lit(True)).select(F.col("v").alias("x"), F.col("m"))
    if not large:
        linked = linked.unionByName(least.select(F.col("u").alias("x"), "m"))
    return linked.where("x <> m").select(F.least("x", "m").alias("u"), F.greatest("x", "m").alias("v")).distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for each end of an edge (u, v): the component is its least node.

    Each step is a grouping and a join, written to the shared folder; the driver sees counts only.  Nodes are integers; no
    edges give no rows.
    """
    now = stored(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        now = stored(_rewired(_rewired(now, True), False), "edges")
        was, seen = seen, mark(now)
        if was == seen:
            break
    else:
        raise RuntimeError("the components have not settled")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
