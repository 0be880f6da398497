"""The keyword graph as edge tables: degrees, density, bounded distances, communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import discard, materialize

#: Rows of a table of nodes that is broadcast (a few MB); a larger one is joined by a shuffle.
SMALL = 100_000


def small(df: DataFrame) -> DataFrame:
    """df with a hint to broadcast it if it has SMALL rows at most, else as it is."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def both_ways(edges: DataFrame) -> DataFrame:
    """(node, other, weight): every edge from both ends; a loop twice."""
    e = edges.select(F.col("keyword_a").alias("node"), F.col("keyword_b").alias("other"), "weight")
    return e.unionByName(e.select(F.col("other").alias("node"), F.col("node").alias("other"), "weight"))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def density(edges: DataFrame) -> DataFrame:
    n = both_ways(edges).agg(F.countDistinct("node").alias("n_nodes"))
    return n.join(edges.agg(F.count("*").alias("n_edges"))).select("n_nodes", "n_edges", F.round(F.col("n_edges") / F.greatest(F.lit(1.0), F.col("n_nodes") * (F.col("n_nodes") - 1) / 2), 4).alias("density"))


def hops(edges: DataFrame, sources: DataFrame, most: int = 3) -> DataFrame:
    """(source, node, hops): least number of edges from each source node, up to most; one join a hop, seen pairs left out."""
    e = both_ways(edges).select("node", "other").distinct()
    front = seen = sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("hops"))
    for k in range(1, most + 1):
        step = front.join(e, "node").select("source", F.col("other").alias("node")).distinct()
        front = step.join(seen, ["source", "node"], "left_anti").withColumn("hops", F.lit(k))
        seen = seen.unionByName(front)
    return seen


def distances(edges: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """(source, node, distance): the least sum of edge weights from each source node, up to `most`.

    Bellman-Ford by joins: only nodes whose distance fell go into the next round, and no sum over the limit is kept; weights are
    positive, so there are most / (least weight) rounds at the utmost. Every round is a written table.
    """
    e = materialize(both_ways(edges).groupBy("node", "other").agg(F.min("weight").cast("double").alias("w")), "weighted")
    front = seen = materialize(sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("distance")).distinct(), "distances")
    while True:
        step = front.join(e, "node").select("source", F.col("other").alias("node"), (F.col("distance") + F.col("w")).alias("distance")).filter(F.col("distance") <= most)
        step = step.groupBy("source", "node").agg(F.min("distance").alias("distance"))
        old = seen.select("source", "node", F.col("distance").alias("known"))
        fell = materialize(step.join(old, ["source", "node"], "left").filter("known is null or distance < known").select("source", "node", "distance"), "fell")
        if not fell.limit(1).count():
            return seen
        seen = materialize(seen.unionByName(fell).groupBy("source", "node").agg(F.min("distance").alias("distance")), "distances")
        front = fell


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each component."""
    return connected_components(edges, "keyword_a", "keyword_b").select("node", F.col("root").alias("component"))


def prune(edges: DataFrame, top_n: int) -> DataFrame:
    """Edges among the five largest components and the top_n nodes by degree, where there are over 3 * top_n nodes."""
    d = degrees(edges)
    if d.count() <= 3 * top_n:
        return edges
    c = components(edges)
    largest = c.groupBy("component").count().orderBy(F.desc("count"), "component").limit(5)
    keep = c.join(largest, "component", "left_semi").select("node").union(d.orderBy(F.desc("degree"), "node").limit(top_n).select("node")).distinct()
    return edges.join(keep, edges["keyword_a"] == keep["node"], "left_semi").join(keep, edges["keyword_b"] == keep["node"], "left_semi")


def modularity(edges: DataFrame, partition: DataFrame, resolution: float = 1.0) -> float:
    """Of a partition (node, community): the share of weight inside communities less the share expected by the degrees."""
    e = edges.join(partition.select(F.col("node").alias("keyword_a"), F.col("community").alias("ca")), "keyword_a").join(partition.select(F.col("node").alias("keyword_b"), F.col("community").alias("cb")), "keyword_b")
    total = e.agg(F.sum("weight").alias("w"), F.coalesce(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("weight"))), F.lit(0)).alias("inside")).first()
    if not total.w:
        return 0.0
    d = both_ways(edges).join(partition, "node").groupBy("community").agg(F.sum("weight").alias("d"))
    expected = d.agg(F.sum((F.col("d") / (2.0 * total.w)) ** 2)).first()[0]
    return float(total.inside / total.w - resolution * expected)


def communities(edges: DataFrame, resolution: float = 1.5, rounds: int = 20, levels: int = 20) -> DataFrame:
    """(node, community) by modularity: local moves, then the same on the graph of communities, until nothing moves.

    All of it is joins over written edge tables, whatever the size of the graph. In a round every node looks for the neighbouring
    community that gains most; of two nodes that would follow each other only one half moves in a round (by a hash of node and round),
    so moves do not undo each other. resolution multiplies the expected weight: higher is finer. Ties go to the least label, the
    name of a community is its least node, so the result is one only.
    """
    level = materialize(edges.select(F.least("keyword_a", "keyword_b").alias("a"), F.greatest("keyword_a", "keyword_b").alias("b"), F.col("weight").cast("double").alias("w")).groupBy("a", "b").agg(F.sum("w").alias("w")), "level")
    member = materialize(level.select(F.col("a").alias("node")).union(level.select("b")).distinct().select("node", F.col("node").alias("community")), "member")
    total = level.agg(F.sum("w")).first()[0]
    if not total:
        return member
    for _ in range(levels):
        moved = _local_moves(level, resolution, 2 * total, rounds)
        if moved is None:
            break
        up = moved.select(F.col("node").alias("community"), F.col("label"))
        member = materialize(member.join(up, "community").select("node", F.col("label").alias("community")), "member")
        ends = level.join(moved.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(moved.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        level = materialize(ends.groupBy(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).agg(F.sum("w").alias("w")), "level")
    least = member.groupBy("community").agg(F.min("node").alias("name"))
    return member.join(least, "community").select("node", F.col("name").alias("community"))


def _local_moves(level: DataFrame, resolution: float, total: float, rounds: int) -> DataFrame | None:
    """(node, label) after moves that raise modularity, or None if there is none. total: twice the weight of all edges."""
    ends = level.select(F.col("a").alias("node"), F.col("b").alias("other"), "w").unionByName(level.select(F.col("b").alias("node"), F.col("a").alias("other"), "w"))
    degree = materialize(ends.groupBy("node").agg(F.sum("w").alias("d")), "degree")
    near = materialize(ends.filter("node <> other"), "near")
    labels = materialize(degree.select("node", "d", F.col("node").alias("label")), "labels")
    ever = False
    for k in range(rounds):
        inside = labels.groupBy("label").agg(F.sum("d").alias("inside"))
        to = near.join(labels.select(F.col("node").alias("other"), F.col("label").alias("to")), "other").groupBy("node", "to").agg(F.sum("w").alias("w"))
        own = labels.select("node", F.col("label").alias("to"), F.lit(0.0).alias("w"))
        to = to.unionByName(own).groupBy("node", "to").agg(F.sum("w").alias("w")).join(labels, "node").join(inside.withColumnRenamed("label", "to"), "to")
        stays = F.col("to") == F.col("label")
        gain = F.round(F.col("w") - resolution * F.col("d") * (F.col("inside") - F.when(stays, F.col("d")).otherwise(0.0)) / total, 9)
        best = to.groupBy("node", "d", "label").agg(F.min(F.struct((-gain).alias("less"), F.col("to"))).alias("best"), F.max(F.when(stays, gain)).alias("now"))
        # half of the nodes move at a time, so that neighbours do not swap places for ever; a move must gain
        turn = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(2)) == 0
        moves = turn & (-F.col("best.less") > F.col("now") + 1e-9) & (F.col("best.to") != F.col("label"))
        new = materialize(best.select("node", "d", F.when(moves, F.col("best.to")).otherwise(F.col("label")).alias("label"), moves.alias("moved"), (-F.col("best.less") > F.col("now") + 1e-9).alias("could")), "labels")
        counts = new.agg(F.count_if("moved").alias("moved"), F.count_if("could").alias("could")).first()
        discard(labels)
        labels = new.select("node", "d", "label")
        labels._paperloom_path = new._paperloom_path
        ever = ever or counts.moved > 0
        if not counts.could:
            break
    return labels.select("node", "label") if ever else None
