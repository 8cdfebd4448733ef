"""Connected components of an edge table, by alternating stars.

Each round points every node's larger neighbours, then its smaller ones, to
the smallest node nearby, until every edge runs from a node to the smallest
of its component. A round is two aggregations and two joins; its edges are
written to the shared folder, so plans stay short and a lost executor costs
one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) -> edges from the neighbours of u to the smallest one."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> (node, root): the smallest node of each node's
    component, for the nodes that have an edge to another one."""
    state = cut(edges.where("u <> v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        state = cut(_star(_star(state, True), False), "links")
