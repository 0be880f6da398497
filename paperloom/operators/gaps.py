"""Gaps between frontiers: density, bridge, temporal, semantic and broker gaps, and their common ranking.

fk: (community, score, growth, node), the top keywords of each frontier; a few rows a frontier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import names_a_gap
from .graph import both_ways, degrees, hops, small
from .graph import distances as weighted


def frontier_keywords(frontiers: DataFrame) -> DataFrame:
    return frontiers.select("community", F.col("frontier_score").alias("score"), F.col("avg_growth_rate").alias("growth"), F.explode("top_keywords").alias("node"))


def _pairs(fk: DataFrame) -> DataFrame:
    """(f1, f2, n1, n2, s1, s2, g1, g2): each two frontiers once; as few rows as frontiers squared."""
    f = fk.groupBy("community").agg(F.count("*").alias("n"), F.first("score").alias("s"), F.first("growth").alias("g"))
    one, two = [f.select(F.col("community").alias(f"f{i}"), F.col("n").alias(f"n{i}"), F.col("s").alias(f"s{i}"), F.col("g").alias(f"g{i}")) for i in (1, 2)]
    return one.join(small(two), F.col("f1") < F.col("f2"))


def _direct(edges: DataFrame, fk: DataFrame) -> DataFrame:
    b = both_ways(edges).select("node", "other")
    x, y = small(fk.select("node", F.col("community").alias("f1"))), small(fk.select(F.col("node").alias("other"), F.col("community").alias("f2")))
    return b.join(x, "node").join(y, "other").filter("f1 < f2").groupBy("f1", "f2").agg(F.count("*").alias("direct"))


def density_gaps(edges: DataFrame, fk: DataFrame, freq: DataFrame, n_papers: int, proximity_over: float = 0.5) -> DataFrame:
    """(keyword, density, proximity, nearby_frontier): rare keywords tied closely to one frontier."""
    near = both_ways(edges).join(small(fk.select(F.col("node").alias("other"), "community")), "other").groupBy("node", "community").agg(F.avg("weight").alias("w"))
    best = near.groupBy("node").agg(F.min(F.struct((-F.col("w")).alias("w"), "community")).alias("b")).select("node", (-F.col("b.w")).alias("w"), F.col("b.community").alias("nearby_frontier"))
    d = degrees(edges).join(small(fk.select("node")), "node", "left_anti").join(freq.withColumnRenamed("keyword", "node"), "node").join(best, "node")
    d = d.filter((F.col("total_count") > 0) & (F.col("total_count") <= 0.1 * n_papers) & names_a_gap(F.col("node")))
    proximity = F.least(F.lit(1.0), F.col("w") / F.greatest(F.lit(1), F.col("total_count")) / F.greatest(F.lit(1), F.col("weighted_degree")))
    return d.select(F.col("node").alias("keyword"), (F.col("total_count") / n_papers).alias("density"), proximity.alias("proximity"), "nearby_frontier").filter(F.col("proximity") > proximity_over)


def bridge_gaps(edges: DataFrame, fk: DataFrame) -> DataFrame:
    """(f1, f2, ratio, shared, potential, ...): frontiers with common neighbours and few edges between them."""
    nbr = both_ways(edges).join(small(fk.select("node", "community")), "node").select("community", "other").distinct()
    shared = nbr.select(F.col("community").alias("f1"), "other").join(nbr.select(F.col("community").alias("f2"), "other"), "other").filter("f1 < f2").groupBy("f1", "f2").agg(F.count("*").alias("shared"), F.slice(F.array_sort(F.collect_set("other")), 1, 10).alias("shared_neighbors"))
    p = _pairs(fk).join(_direct(edges, fk), ["f1", "f2"], "left").join(shared, ["f1", "f2"], "left")
    size = F.col("n1") * F.col("n2")
    p = p.withColumn("ratio", F.coalesce("direct", F.lit(0)) / size).withColumn("overlap", F.coalesce("shared", F.lit(0)) / (F.col("n1") + F.col("n2")))
    p = p.filter((F.col("ratio") < F.when(size > 30, 0.35).otherwise(0.25)) & (F.col("overlap") > 0))
    return p.withColumn("potential", F.col("overlap") * (1 - F.col("ratio"))).select("f1", "f2", "shared", "shared_neighbors", "ratio", "potential", "s1", "s2", "g1", "g2")


def distances(edges: DataFrame, fk: DataFrame, most: float, *, by_weight: bool = False) -> DataFrame:
    """(f1, f2, distance): the least way between the keywords of two frontiers, up to `most`: in hops, or as a sum of edge weights."""
    sources = fk.select("node").distinct()
    h = weighted(edges, sources, most).filter("source <> node") if by_weight else hops(edges, sources, int(most)).filter("hops > 0").withColumnRenamed("hops", "distance")
    x, y = small(fk.select(F.col("node").alias("source"), F.col("community").alias("f1"))), small(fk.select("node", F.col("community").alias("f2")))
    return h.join(x, "source").join(y, "node").filter("f1 < f2").groupBy("f1", "f2").agg(F.min("distance").alias("distance"))


def semantic_gaps(edges: DataFrame, fk: DataFrame, *, most: float = 4, score_over: float = 0.2, cap: float = 0.85, top: int = 10, by_weight: bool = False) -> DataFrame:
    """(f1, f2, distance, score): frontiers without an edge between them, a short way apart. by_weight: a way's length is the sum of
    its weights, so that strong ties count as far, as the batch scripts have it."""
    p = _pairs(fk).join(_direct(edges, fk), ["f1", "f2"], "left_anti").join(distances(edges, fk, most, by_weight=by_weight), ["f1", "f2"])
    score = F.least(F.lit(cap), (F.col("s1") + F.col("s2")) / 2 / F.greatest(F.lit(1), F.col("distance")))
    return p.select("f1", "f2", "distance", F.round(score, 3).alias("score")).filter(F.col("score") > score_over).orderBy(F.desc("score"), "f1", "f2").limit(top)


def broker_gaps(edges: DataFrame, fk: DataFrame, top: int | None = None) -> DataFrame:
    """(keyword, n_frontiers, score): keywords outside all frontiers that touch two or more; the best `top` by score."""
    d = degrees(edges)
    most = d.agg(F.max("weighted_degree").alias("most"))
    near = both_ways(edges).join(small(fk.select(F.col("node").alias("other"), "community")), "other").join(small(fk.select("node")), "node", "left_anti")
    n = near.groupBy("node").agg(F.countDistinct("community").alias("n_frontiers")).filter("n_frontiers >= 2").join(d, "node").join(F.broadcast(most))
    score = F.least(F.lit(0.85), 0.4 + F.least(F.lit(0.25), 0.08 * (F.col("n_frontiers") - 2)) + 0.2 * F.col("weighted_degree") / F.col("most"))
    out = n.filter(names_a_gap(F.col("node"))).select(F.col("node").alias("keyword"), "n_frontiers", F.round(score, 3).alias("score"))
    return out if top is None else out.orderBy(F.desc("score"), "keyword").limit(top)


def hop_bridges(edges: DataFrame, fk: DataFrame, most: int = 3) -> DataFrame:
    """(f1, f2, distance, score): the fallback's bridges, frontiers without an edge at most three hops apart."""
    p = _pairs(fk).join(_direct(edges, fk), ["f1", "f2"], "left_anti").join(distances(edges, fk, most), ["f1", "f2"])
    return p.select("f1", "f2", "distance", F.round(0.5 + 0.15 / F.greatest(F.lit(1), F.col("distance")), 3).alias("score"))


def inferred_gaps(edges: DataFrame, fk: DataFrame, top: int = 20) -> DataFrame:
    """(rank, gap_type, label, gap_score, opportunity): brokers and bridges by topology alone, for corpora in which nothing can be measured."""
    b = broker_gaps(edges, fk).select(F.lit("density").alias("gap_type"), F.concat(F.lit("Broker: "), "keyword").alias("label"), F.col("score").alias("gap_score"), F.when(F.col("n_frontiers") >= 3, "high").otherwise("medium").alias("opportunity"))
    h = hop_bridges(edges, fk).select(F.lit("bridge").alias("gap_type"), F.concat(F.lit("Bridge: "), F.concat_ws(" <-> ", "f1", "f2")).alias("label"), F.col("score").alias("gap_score"), F.lit("medium").alias("opportunity"))
    every = b.unionByName(h).orderBy(F.desc("gap_score"), "gap_type", "label").limit(top)
    rank = F.row_number().over(Window.orderBy(F.desc("gap_score"), "gap_type", "label"))  # at most top rows
    return every.select(rank.alias("rank"), "gap_type", "label", "gap_score", "opportunity")


def ranked_or_inferred(ranked: DataFrame, edges: DataFrame, fk: DataFrame, top: int = 20, least_nodes: int = 4) -> DataFrame:
    """ranked, or, where it is empty although there are frontiers and a graph of some size, what topology suggests."""
    if ranked.limit(1).count() or not fk.limit(1).count() or both_ways(edges).select("node").distinct().limit(least_nodes).count() < least_nodes:
        return ranked
    return inferred_gaps(edges, fk, top)


def gap_counts(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("gap_type").agg(F.count("*").alias("n"))


def rank_gaps(density: DataFrame, bridge: DataFrame, temporal: DataFrame, growth: DataFrame, last_year: int, semantic: DataFrame | None = None, top: int | None = 20) -> DataFrame:
    """(rank, gap_type, label, gap_score, opportunity): all gaps on one scale. growth: keyword, cagr_3yr."""
    g = F.when(F.col("cagr_3yr").isNull() | (F.col("cagr_3yr") == float("inf")) | (F.col("cagr_3yr") < -1), 0.3).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("cagr_3yr"))))
    one = lambda x: F.least(F.lit(1.0), x)
    no_way = F.lit(None).cast("double").alias("way")
    d = density.join(growth.select("keyword", "cagr_3yr"), "keyword", "left").select(F.lit("density").alias("gap_type"), F.col("keyword").alias("label"), (0.35 * (1 - one(5 * F.col("density"))) + 0.3 * F.col("proximity") + 0.2 * g + 0.075).alias("s"), no_way)
    b = bridge.select(F.lit("bridge").alias("gap_type"), F.concat_ws(" <-> ", "f1", "f2").alias("label"), (0.3 * (1 - one(3 * F.col("ratio"))) + 0.25 * (F.col("s1") + F.col("s2")) / 2 + 0.2 * F.col("potential") + 0.15 * one((F.col("g1") + F.col("g2")) / 2) + 0.05).alias("s"), no_way)
    t = temporal.select(F.lit("temporal").alias("gap_type"), F.col("keyword").alias("label"), (0.35 * (1 - one(2 * F.col("decline_ratio"))) + 0.25 * one((last_year - F.col("peak_year")) / 10) + 0.06 + 0.1).alias("s"), no_way)
    every = d.unionByName(b).unionByName(t)
    if semantic is not None:
        every = every.unionByName(semantic.select(F.lit("semantic").alias("gap_type"), F.concat_ws(" <-> ", "f1", "f2").alias("label"), F.col("score").cast("double").alias("s"), F.col("distance").cast("double").alias("way")))
    every = every.select("gap_type", "label", F.round("s", 3).alias("gap_score"), "way")
    if top is not None:
        every = every.orderBy(F.desc("gap_score"), "gap_type", "label").limit(top)
    rank = F.row_number().over(Window.orderBy(F.desc("gap_score"), "gap_type", "label"))  # at most top rows
    high = F.when(F.col("gap_type") == "semantic", F.col("way") <= 2).when(F.col("gap_type") == "temporal", F.col("gap_score") > 0.5).otherwise(F.col("gap_score") > 0.6)
    return every.select(rank.alias("rank"), "gap_type", "label", "gap_score", F.when(high, "high").otherwise("medium").alias("opportunity"))
