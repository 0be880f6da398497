"""Communities of the keyword graph scored as research frontiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import clamp
from .graph import both_ways, small


def _ends(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """Every edge from both ends with the communities of its ends: community, there."""
    p = small(partition.select("node", "community"))
    return both_ways(edges).join(p, "node").join(p.select(F.col("node").alias("other"), F.col("community").alias("there")), "other")


def top_nodes(edges: DataFrame, partition: DataFrame, n: int = 5) -> DataFrame:
    """(community, node, rank, inner_degree): the n nodes of most weight inside their community; ties by name."""
    d = _ends(edges, partition).filter("community = there").groupBy("community", "node").agg(F.sum("weight").alias("inner_degree"))
    d = partition.join(d, ["community", "node"], "left").withColumn("inner_degree", F.coalesce("inner_degree", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("community").orderBy(F.desc("inner_degree"), "node"))
    return d.withColumn("rank", rank).filter(F.col("rank") <= n)


def frontiers(edges: DataFrame, partition: DataFrame, trends: DataFrame, yearly: DataFrame, bursts: DataFrame, year_range: DataFrame, *, min_cluster: int = 2, cfg: Config = DEFAULT) -> DataFrame:
    """One row a community with any trend data, best first. trends: the top keywords; year_range: one row (year_min, year_max)."""
    t = yearly.join(small(trends.select("keyword")), "keyword", "left_semi").groupBy("keyword").agg((F.sum(F.col("year") * F.col("n")) / F.sum("n")).alias("mean_year"))
    nodes = partition.join(t.withColumnRenamed("keyword", "node"), "node", "left").join(trends.select(F.col("keyword").alias("node"), "cagr_3yr"), "node", "left")
    fine = F.col("cagr_3yr").isNotNull() & (F.col("cagr_3yr") != float("inf")) & (F.col("cagr_3yr") >= 0)
    c = nodes.groupBy("community").agg(F.count("*").alias("node_count"), F.avg("mean_year").alias("avg_year"), F.coalesce(F.sum(F.when(fine, F.col("cagr_3yr").cast("decimal(18,3)"))).cast("double") / F.nullif(F.count_if(fine), F.lit(0)), F.lit(0.0)).alias("avg_growth"))
    c = c.filter((F.col("node_count") >= min_cluster) & F.col("avg_year").isNotNull())
    burst = partition.join(bursts.withColumnRenamed("keyword", "node"), "node").groupBy("community").agg(F.max("intensity").alias("max_burst"), F.avg("intensity").alias("mean_burst"), F.array_sort(F.collect_set("node")).alias("burst_keywords"))
    cross = _ends(edges, partition).filter("community <> there").groupBy("community").agg(F.count("*").alias("cross_edges"))
    top = top_nodes(edges, partition).groupBy("community").agg(F.array_sort(F.collect_list(F.struct("rank", "node"))).alias("top"))
    c = c.join(burst, "community", "left").join(cross, "community", "left").join(top, "community").join(F.broadcast(year_range))
    # rates have three places and are summed exactly; what falls between two roundings goes up, on any engine
    c = c.withColumn("avg_growth", F.col("avg_growth") + 1e-9)
    for name in ("max_burst", "mean_burst", "cross_edges"):
        c = c.withColumn(name, F.coalesce(name, F.lit(0)))
    span = F.col("year_max") - F.col("year_min")
    c = c.withColumn("recency_norm", F.when(span > 0, clamp((F.col("avg_year") - F.col("year_min")) / F.when(span > 0, span))).otherwise(0.5))
    c = c.withColumn("growth_norm", clamp(F.col("avg_growth"))).withColumn("burst_norm", clamp((0.7 * F.col("max_burst") + 0.3 * F.col("mean_burst")) / 10)).withColumn("cross_norm", clamp(F.col("cross_edges") / F.greatest(F.lit(1), F.col("node_count")) / 5))
    score = cfg.weight_burst * F.col("burst_norm") + cfg.weight_recency * F.col("recency_norm") + cfg.weight_growth * F.col("growth_norm") + cfg.weight_cross * F.col("cross_norm")
    score = score * F.when(F.col("node_count") > 60, 0.5).when(F.col("node_count") > 30, 0.8).otherwise(1.0)
    names = F.transform("top", lambda x: x["node"])
    out = c.select(
        "community", F.array_join(F.slice(names, 1, 3), " / ").alias("label"), names.alias("top_keywords"), F.coalesce("burst_keywords", F.array().cast("array<string>")).alias("burst_keywords"), F.col("node_count"),
        F.round("avg_year", 1).alias("avg_year"), F.round("avg_growth", 3).alias("avg_growth_rate"), F.round("max_burst", 2).alias("max_burst_intensity"), F.col("cross_edges").alias("cross_cluster_edges"),
        F.round("recency_norm", 3).alias("recency_norm"), F.round("growth_norm", 3).alias("growth_norm"), F.round("burst_norm", 3).alias("burst_norm"), F.round("cross_norm", 3).alias("cross_norm"), F.round(score, 3).alias("frontier_score"),
    )
    return out.orderBy(F.desc("frontier_score"), "community")


def burst_list(bursts: DataFrame, freq: DataFrame, trends: DataFrame) -> DataFrame:
    """(keyword, total, cagr_3yr, bursts): the intervals of each bursting keyword in order, those with the strongest first one first."""
    b = bursts.groupBy("keyword").agg(F.array_sort(F.collect_list(F.struct(F.col("burst_start").alias("start"), F.col("burst_end").alias("end"), "intensity"))).alias("bursts"))
    b = b.join(freq.select("keyword", F.col("total_count").alias("total")), "keyword").join(trends.select("keyword", "cagr_3yr"), "keyword", "left")
    return b.select("keyword", "total", "cagr_3yr", "bursts").orderBy(F.desc(F.get("bursts", F.lit(0))["intensity"]), "keyword")


def active_bursts(bursts: DataFrame, years: DataFrame) -> int:
    """Keywords whose last burst reaches the second-last observed year; all of them where there are fewer than two years."""
    last = [r.year for r in years.orderBy(F.desc("year")).limit(2).collect()]
    ends = bursts.groupBy("keyword").agg(F.max("burst_end").alias("end"))
    return ends.count() if len(last) < 2 else ends.filter(F.col("end") >= last[1]).count()
