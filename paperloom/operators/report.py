"""Tables for reports: graph view, trend chart, frontier-gap matrix, plain summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import hue, node_size
from .graph import both_ways, small
from .quality import confidence, item_confidence


def vis_edges(edges: DataFrame, min_weight: int = 2) -> DataFrame:
    e = edges.filter(F.col("weight") >= min_weight)
    most = e.agg(F.max("weight").alias("most"))
    return e.join(F.broadcast(most)).select(F.col("keyword_a").alias("source"), F.col("keyword_b").alias("target"), F.round(F.col("weight") / F.col("most") * 5, 2).alias("value"))


def vis_nodes(edges: DataFrame, partition: DataFrame) -> DataFrame:
    n = both_ways(edges).groupBy("node").agg(F.sum("weight").alias("freq"))
    return n.join(small(partition), "node", "left").select(F.col("node").alias("id"), node_size(F.col("freq")).alias("value"), F.col("community").alias("group"))


def marked_nodes(edges: DataFrame, frontiers: DataFrame, gap_keywords: DataFrame) -> DataFrame:
    """(id, value, group, hue, in_frontier, in_gap, border): nodes of the graph view. A node belongs to the best frontier that has it
    among its top keywords; a gap's keyword has a border of three, a frontier's one of two. gap_keywords: keyword."""
    order = Window.orderBy(F.desc("frontier_score"), "community")  # one row a frontier
    f = frontiers.select("label", "top_keywords", (F.row_number().over(order) - 1).alias("at"))
    own = f.select("at", "label", F.explode("top_keywords").alias("id")).groupBy("id").agg(F.min(F.struct("at", "label")).alias("f"))
    n = both_ways(edges).groupBy(F.col("node").alias("id")).agg(F.sum("weight").alias("freq"))
    n = n.join(small(own), "id", "left").join(small(gap_keywords.select(F.col("keyword").alias("id"), F.lit(True).alias("gap")).distinct()), "id", "left")
    in_frontier, in_gap = F.col("f").isNotNull(), F.coalesce("gap", F.lit(False))
    return n.select(
        "id", node_size(F.col("freq")).alias("value"), F.coalesce("f.label", F.lit("other")).alias("group"), hue(F.col("f.at")).alias("hue"), in_frontier.alias("in_frontier"), in_gap.alias("in_gap"),
        F.when(in_gap, 3).when(in_frontier, 2).otherwise(1).alias("border"),
    )


def highlights(frontiers: DataFrame, gap_keywords: DataFrame | None = None, bridges: DataFrame | None = None) -> DataFrame:
    """(keyword): what a trend chart shows: the top five keywords of each frontier, keywords of gaps, five shared neighbours of each bridge."""
    out = frontiers.select(F.explode(F.slice("top_keywords", 1, 5)).alias("keyword"))
    if gap_keywords is not None:
        out = out.unionByName(gap_keywords.select("keyword"))
    if bridges is not None:
        out = out.unionByName(bridges.select(F.explode(F.slice("shared_neighbors", 1, 5)).alias("keyword")))
    return out.distinct()


def trend_chart(yearly: DataFrame, highlight: DataFrame, years: list[int], trends: DataFrame | None = None) -> DataFrame:
    """(keyword, total, series[, trend]): a dense comma-joined series over the observed years, largest total first. highlight: keyword."""
    y = yearly.join(small(highlight.select("keyword").distinct()), "keyword", "left_semi")
    m = y.groupBy("keyword").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("year", "n"))).alias("m"))
    series = F.transform(F.array(*map(F.lit, years)), lambda t: F.coalesce(F.try_element_at("m", t), F.lit(0)).cast("string"))
    out = m.select("keyword", "total", F.array_join(series, ",").alias("series"))
    if trends is not None:
        out = out.join(trends.select("keyword", "trend"), "keyword", "left")
    return out.orderBy(F.desc("total"), "keyword")


def frontier_gap_matrix(edges: DataFrame, fk: DataFrame, gaps: DataFrame, top: int = 10) -> DataFrame:
    """(gap, frontier, relevance): of `top` gaps (as many as are given) and the `top` best frontiers. gaps: gap, keyword, home (its own
    frontier or null). A gap is relevant to its home, and to a frontier by the share of its keywords that are neighbours."""
    size = fk.groupBy("community").agg(F.count("*").alias("n"), F.max("score").alias("score")).orderBy(F.desc("score"), "community").limit(top)
    gaps = gaps.orderBy("gap").limit(top)
    nbr = both_ways(edges).select(F.col("node").alias("keyword"), "other").distinct()
    near = gaps.join(nbr, "keyword").join(small(fk.select(F.col("node").alias("other"), "community")), "other").groupBy("gap", "community").agg(F.count("*").alias("overlap"))
    grid = gaps.select("gap", "home").join(F.broadcast(size)).join(near, ["gap", "community"], "left")
    relevance = F.greatest(F.when(F.col("home") == F.col("community"), 0.8).otherwise(0.0), F.least(F.lit(1.0), F.coalesce("overlap", F.lit(0)) / F.col("n")))
    return grid.select("gap", F.col("community").alias("frontier"), F.round(relevance, 3).alias("relevance"))


def paper_rows(papers: DataFrame, top: int = 200) -> DataFrame:
    """The first `top` papers by id, their texts cut for a report's context."""
    cut = lambda c, n: F.substring(F.coalesce(c, F.lit("")), 1, n)
    keywords = "keywords_normalized" if "keywords_normalized" in papers.columns else "keywords"
    out = papers.orderBy("id").limit(top)
    return out.select("id", cut("title", 200).alias("title"), F.coalesce("doi", F.lit("")).alias("doi"), "year", cut(F.array_join("authors", "; "), 100).alias("authors"), cut("journal", 100).alias("journal"), cut(F.array_join(keywords, "; "), 200).alias("keywords"))


def papers_by_year(papers: DataFrame, keyword: str, top: int = 5) -> DataFrame:
    """(year, titles): papers with a keyword, the first `top` titles of each year."""
    p = papers.filter(F.array_contains("keywords", keyword)).select("year", "title")
    p = p.withColumn("at", F.row_number().over(Window.partitionBy("year").orderBy("title"))).filter(F.col("at") <= top)
    return p.groupBy("year").agg(F.array_sort(F.collect_list("title")).alias("titles")).orderBy("year")


def search(df: DataFrame, column: str, term: str) -> DataFrame:
    return df.filter(F.contains(F.lower(F.col(column)), F.lit(term.lower())))


#: What a gap of each kind means, and what to do about it.
MEANING = {
    "density": ("'{0}' is rare in the corpus and closely tied to a frontier.", "Study '{0}' with the methods of the frontier beside it."),
    "bridge": ("{0} share neighbours but have few edges between them.", "Carry methods across {0}."),
    "temporal": ("'{0}' was frequent early and has nearly gone.", "See whether what stopped '{0}' still holds."),
    "semantic": ("{0} are a short way apart without a single edge.", "Apply what one of {0} has found to the other."),
}


def markdown(title: str, frontiers: DataFrame, gaps: DataFrame, n: int = 10, stats: dict | None = None) -> str:
    """A report of at most n frontiers and n gaps."""
    lines = [f"# {title}", ""]
    if stats:
        lines += [f"{stats['n_papers']} papers, {stats['n_keywords']} keywords, {stats['n_cooccurrence']} pairs of keywords, verdict {stats['verdict']}.", ""]
    lines += ["## Frontiers", ""]
    for i, r in enumerate(frontiers.orderBy(F.desc("frontier_score"), "community").limit(n).collect(), 1):
        lines.append(f"{i}. {r['label']} ({r['node_count']} keywords, score {r['frontier_score']})")
    lines += ["", "## Gaps", ""]
    for r in gaps.orderBy("rank").limit(n).collect():
        lines.append(f"{r['rank']}. [{r['gap_type']}] {r['label']}: {r['gap_score']} ({r['opportunity']})")
        lines.append(f"   {MEANING.get(r['gap_type'], ('', ''))[0].format(r['label'])}")
    return "\n".join(lines) + "\n"


def summary_text(context: dict) -> str:
    """The plain summary of a report's context: counts and confidence, the best frontiers and gaps, the most frequent keywords."""
    stats = context["corpus_stats"]
    n, years, percent = stats["n_papers"], stats["year_range"], stats["abstract_pct"]
    span = years[1] - years[0] + 1 if years else 0
    out = ["=== Summary ===", f"Papers: {n}" + (f", years {years[0]}-{years[1]}" if years else ""), f"Frontiers: {len(context['frontiers'])}, gaps: {len(context['gaps'])}", f"Confidence: {confidence(n, span, percent)} ({n} papers, {span} years, {percent:.0f} % with abstracts)"]
    out += [f"  Warning: {w}" for bad, w in ((n < 50, f"few papers ({n})"), (span < 5, f"few years ({span})"), (percent < 50, f"few abstracts ({percent:.0f} %)")) if bad]
    out += ["", "--- Frontiers ---"]
    for i, f in enumerate(context["frontiers"][:5], 1):
        out += [f"{i}. {f['label']}, score {f['frontier_score']:.3f} [{item_confidence(f['frontier_score'], frontier=True)}]", f"   {', '.join(f['top_keywords'][:4])}"]
    out += ["", "--- Gaps ---"]
    for i, g in enumerate(context["gaps"][:5], 1):
        inferred = g["label"].startswith(("Broker: ", "Bridge: "))
        out += [f"{i}. [{g['gap_type']}] {g['label']}, score {g['gap_score']:.3f} [{item_confidence(g['gap_score'], inferred=inferred)}]", f"   {MEANING.get(g['gap_type'], ('', ''))[1].format(g['label'])}"]
    out += ["", "--- Keywords ---", *[f"{k['keyword']}: {k['total_count']} ({k['trend']})" for k in context["top_keywords"][:10]]]
    return "\n".join(out) + "\n"
