"""Shortest distances from a set of nodes, in few rounds on long chains.

A node with a single way in gets its distance from the node before it, so it
need not be walked to: it is contracted. Pointers to the node before are
doubled until each of them ends at a node that stays, which takes log n rounds
for a chain of n nodes; edges then start from where the pointers end. Nodes
whose ways in have become one that way are contracted in the next phase, so
chains of diamonds shrink as well. What is left is walked edge by edge, and
the contracted nodes get their distances from its nodes, phase by phase.
Pointers that go round without an end belong to nodes that no source reaches.

A walk that has not ended after ``PATIENCE`` rounds goes on by clusters of
neighbouring nodes, of ``CLUSTER`` edge ends at most: a round takes the
distances through whole clusters, each in a task, and over the edges between
clusters by a join. So a way costs as many rounds as it changes clusters, and
never more than it has edges. Nodes of more edges are in no cluster.

Every step is a join or an aggregation on node keys and is written to the
shared folder, so plans stay short and a lost executor costs one step.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

WORTH = 0.2     # share of the nodes that a phase must contract to go on
PATIENCE = 12   # rounds of the walk before clusters are made
CLUSTER = 1 << 16
FEW = 0.02      # share of the clusters that a round must merge to go on


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _roots(single: DataFrame) -> DataFrame:
    """(node, up, len) with up in a row of its own or not -> the same with up
    at the end of the way; rows whose way has no end are left out."""
    left = single.count()
    state = single.withColumn("open", F.lit(True))
    rounds = max(1, left).bit_length() + 1
    for _ in range(rounds):
        # the pointers so far, also those that have ended, as next steps
        step = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("len").alias("len2"), F.col("open").alias("open2"))
        ended = state.where("NOT open")
        moved = state.where("open").join(step, "up", "left").select(
            "node", F.coalesce("up2", "up").alias("up"), (F.col("len") + F.coalesce("len2", F.lit(0))).alias("len"),
            F.coalesce("open2", F.lit(False)).alias("open"))
        state = _written(ended.unionByName(moved), "reach-pointers")
        if state.where("open").isEmpty():
            break
    return state.where("NOT open").drop("open")


def _clusters(core: DataFrame) -> DataFrame:
    """(node, cluster, n): nodes grown together with their neighbours, a group
    of CLUSTER edge ends at most (n: the node's own). Each round, clusters that
    draw tails join a neighbour that draws heads, as many as it has room for."""
    ends = core.select(F.col("src").alias("node")).unionByName(core.select(F.col("dst").alias("node")))
    place = _written(ends.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") <= CLUSTER)
                     .select("node", F.xxhash64("node").alias("cluster"), "n"), "reach-clusters")
    links = core.select(F.xxhash64("src").alias("a"), F.xxhash64("dst").alias("b"))
    links = _written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "reach-links")
    left = place.count()
    for r in range(2 * max(1, left).bit_length()):
        size = place.groupBy("cluster").agg(F.sum("n").alias("n"))
        tails = size.where(F.xxhash64("cluster", F.lit(r)) % 2 != 0).select(F.col("cluster").alias("a"), F.col("n").alias("na"))
        heads = size.where(F.xxhash64("cluster", F.lit(r)) % 2 == 0).select(F.col("cluster").alias("b"), F.col("n").alias("nb"))
        wish = (links.join(tails, "a").join(heads, "b").where(F.col("na") + F.col("nb") <= CLUSTER)
                .groupBy("a", "na").agg(F.min(F.struct("nb", "b")).alias("to")).select("a", "na", "to.*"))
        taken = F.sum("na").over(Window.partitionBy("b").orderBy("na", "a").rowsBetween(Window.unboundedPreceding, 0))
        moved = _written(wish.withColumn("taken", taken).where(F.col("taken") + F.col("nb") <= CLUSTER)
                         .select(F.col("a").alias("old"), F.col("b").alias("new")), "reach-moved")
        n = moved.count()
        if n:
            place = _written(place.join(moved, F.col("cluster") == F.col("old"), "left")
                             .select("node", F.coalesce("new", "cluster").alias("cluster"), "n"), "reach-clusters")
            for end in "ab":
                links = links.join(moved, F.col(end) == F.col("old"), "left").withColumn(end, F.coalesce("new", end)).select("a", "b")
            links = _written(links.where("a <> b").distinct(), "reach-links")
            left -= n
        if n <= FEW * left:
            break
    return place


def _through(seeds: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
    """The distances of one cluster's nodes by the ways within it."""
    after = defaultdict(list)
    for src, dst, w in zip(ways["src"], ways["dst"], ways["w"]):
        after[src].append((dst, w))
    best: dict = {}
    todo = [(int(d), node) for node, d in zip(seeds["node"], seeds["distance"])]
    heapq.heapify(todo)
    while todo:
        d, node = heapq.heappop(todo)
        if node not in best:
            best[node] = d
            for dst, w in after[node]:
                if dst not in best:
                    heapq.heappush(todo, (d + int(w), dst))
    return pd.DataFrame({"node": list(best), "distance": list(best.values())})


def _least(known: DataFrame, *more: DataFrame) -> DataFrame:
    for x in more:
        known = known.unionByName(x)
    return known.groupBy("node").agg(F.min("distance").alias("distance"))


def _better(found: DataFrame, known: DataFrame) -> DataFrame:
    old = known.select("node", F.col("distance").alias("old"))
    return found.join(old, "node", "left").where("old IS NULL OR distance < old").drop("old")


def _by_clusters(core: DataFrame, known: DataFrame, front: DataFrame) -> DataFrame:
    """The rest of the walk from ``front``, the rows of ``known`` whose ways
    out are still to be taken."""
    place = _clusters(core).drop("n")
    into, out = place.toDF("dst", "to"), place.toDF("src", "cluster")
    ways = _written(core.join(out, "src", "left").join(into, "dst", "left")
                    .select("src", "dst", "w", F.when(F.col("cluster") == F.col("to"), F.col("cluster")).alias("cluster")), "reach-ways")
    inner, outer = ways.where("cluster IS NOT NULL"), ways.where("cluster IS NULL").drop("cluster")
    row = f"node {core.schema['src'].dataType.simpleString()}, distance long"
    while True:
        seeds = front.join(place, "node")
        open_ways = inner.join(seeds.select("cluster").distinct(), "cluster", "left_semi")
        inside = seeds.groupBy("cluster").cogroup(open_ways.groupBy("cluster")).applyInPandas(_through, row)
        grown = _written(_better(inside, known).unionByName(front), "reach-grown")
        known = _written(_least(known, grown), "reach-known")
        ahead = (grown.withColumnRenamed("node", "src").join(outer, "src").groupBy(F.col("dst").alias("node"))
                 .agg(F.min(F.col("distance") + F.col("w")).alias("distance")))
        front = _written(_better(ahead, known), "reach-front")
        if front.isEmpty():
            return known
        known = _written(_least(known, front), "reach-known")


def distances(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """edges (src, dst, w: positive long), sources (node) -> (node, distance)
    of every node that a source reaches, sources included."""
    sources = _written(sources.select("node").distinct(), "reach-sources")
    at_source = sources.select(F.col("node").alias("dst"))
    core = _written(edges.where("src <> dst").join(at_source, "dst", "left_anti")
                    .groupBy("src", "dst").agg(F.min("w").alias("w")), "reach-edges")
    phases: list[DataFrame] = []
    while True:
        into = _written(core.groupBy("dst").agg(F.count("*").alias("n"), F.min(F.struct("src", "w")).alias("p")), "reach-degrees")
        n, one = into.agg(F.count("*"), F.count_if(F.col("n") == 1)).first()
        if not one or one < WORTH * n:
            break
        single = into.where("n = 1").select(F.col("dst").alias("node"), F.col("p.src").alias("up"), F.col("p.w").alias("len"))
        phase = _roots(single)
        phases.append(phase)
        rest = core.join(into.where("n > 1").select("dst"), "dst", "left_semi")
        gone = single.select(F.col("node").alias("src"), F.lit(True).alias("gone"))
        placed = phase.select(F.col("node").alias("src"), "up", "len")
        core = _written(
            rest.join(gone, "src", "left").join(placed, "src", "left")
            .where("gone IS NULL OR up IS NOT NULL")        # ways that start on an endless round
            .select(F.coalesce("up", "src").alias("src"), "dst", (F.col("w") + F.coalesce("len", F.lit(0))).alias("w"))
            .where("src <> dst").groupBy("src", "dst").agg(F.min("w").alias("w")), "reach-edges")
    known = sources.select("node", F.lit(0).cast("long").alias("distance"))
    front = known
    for _ in range(PATIENCE):
        ahead = (front.join(core, front["node"] == core["src"]).groupBy(F.col("dst").alias("node"))
                 .agg(F.min(F.col("distance") + F.col("w")).alias("distance")))
        front = _written(_better(ahead, known), "reach-front")
        if front.isEmpty():
            break
        known = _written(_least(known, front), "reach-known")
    else:
        known = _by_clusters(core, known, front)
    for phase in reversed(phases):
        at = known.select(F.col("node").alias("up"), "distance")
        known = _written(known.unionByName(phase.join(at, "up").select("node", (F.col("distance") + F.col("len")).alias("distance"))),
                         "reach-known")
    return known
