"""Every registered query of the bibliographic engine and, where SQL can express it, its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import adaptive
from ..functions import lexicon
from ..functions import text as T
from ..operators import biblio, dedup, frontier, gaps, graph, keywords, quality, report
from ..operators.store import materialize
from ..sources import corpus_views as V

# ---- shared pieces -----------------------------------------------------------------------------------------------

basket, docs = V.basket_corpus, V.text_corpus
DENSE = 2  # least weight of an edge
SPARSE = 4  # least weight where pairs without an edge are wanted: the full basket has none at 2
#: The reference value, one half, leaves no rows once keywords are distinct; this one asks for any closeness.
PROXIMITY = 0.0003


def first_word(edges):
    """A fixed partition: the first word of a keyword."""
    return graph.both_ways(edges).select("node").distinct().select("node", F.split("node", " ")[0].alias("community"))


class View:
    """The frames that several queries start from. Corpus, the counts by keyword and year, trends and co-occurrence are written once a query."""

    def __init__(self, spark, d, weight=DENSE):
        self.corpus = materialize(basket(spark, d), "corpus")
        self.counts = biblio.keyword_years(self.corpus)
        self.freq, self.yearly, self.years = biblio.freq_of(self.counts), biblio.yearly_of(self.counts), biblio.years_of(self.counts)
        self.n_papers = biblio.papers_of(self.counts)
        self.edges = materialize(biblio.cooccurrence(self.corpus, 200, weight, freq=self.freq), "edges")
        self.partition = first_word(self.edges)
        self.growth = materialize(biblio.trends_of(self.counts), "trends")
        self.trends = biblio.top_trends(self.growth, 100)

    def frontiers(self, partition=None):
        top = self.yearly.join(graph.small(self.trends.select("keyword")), "keyword", "left_semi")
        span = self.years.agg(F.min("year").alias("year_min"), F.max("year").alias("year_max"))
        return frontier.frontiers(self.edges, self.partition if partition is None else partition, self.trends, self.yearly, biblio.bursts(top, self.years), span)

    def fk(self):
        return materialize(gaps.frontier_keywords(self.frontiers()), "fk")

    def density(self, fk):
        return gaps.density_gaps(self.edges, fk, self.freq, self.n_papers, PROXIMITY)


def freq(spark, d):
    return biblio.keyword_freq(basket(spark, d))


def finite(t):
    return t.withColumn("cagr_3yr", F.when(F.col("cagr_3yr") != float("inf"), F.col("cagr_3yr")))


def counts(spark, d):
    return biblio.keyword_years(basket(spark, d))


def trends(spark, d):
    return biblio.trends_of(counts(spark, d))


def labelled(label):
    return lambda s, d: finite(biblio.top_trends(trends(s, d).filter(F.col("trend") == label), 20))


def pivot(spark, d):
    c = counts(spark, d)
    return biblio.pivot_of(c, [r.year for r in biblio.years_of(c).orderBy("year").collect()])


def all_bursts(spark, d):
    c = counts(spark, d)
    return biblio.bursts(biblio.yearly_of(c), biblio.years_of(c))


def recent_bursts(spark, d):
    c = counts(spark, d)
    years = biblio.years_of(c)
    last = years.orderBy(F.desc("year")).limit(2).agg(F.min("year").alias("second_last"))
    b = biblio.bursts(biblio.yearly_of(c), years)
    return b.groupBy("keyword").agg(F.max("burst_end").alias("last_end"), F.count("*").alias("n_bursts")).join(F.broadcast(last)).filter("last_end >= second_last").select("keyword", "last_end", "n_bursts")


def burst_list(spark, d):
    c = counts(spark, d)
    found = frontier.burst_list(biblio.bursts(biblio.yearly_of(c), biblio.years_of(c)), biblio.freq_of(c), biblio.trends_of(c))
    text = F.transform("bursts", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string")))
    return found.select("keyword", "total", F.array_join(text, ";").alias("bursts"))


def temporal(spark, d):
    c = counts(spark, d)
    return biblio.temporal_decline(biblio.yearly_of(c), biblio.years_of(c), biblio.papers_of(c), floor=10, share=0.0)


def edges_of(spark, d):
    return biblio.cooccurrence(basket(spark, d), 200, DENSE)


def ranked(spark, d):
    v = View(spark, d)
    fk = v.fk()
    t = biblio.temporal_decline(v.yearly, v.years, v.n_papers, floor=10, share=0.0)
    last = v.years.agg(F.max("year")).first()[0]
    return gaps.rank_gaps(v.density(fk), gaps.bridge_gaps(v.edges, fk), t, v.growth, last)


def matrix(spark, d):
    v = View(spark, d)
    fk = v.fk()
    g = v.density(fk).orderBy(F.desc("proximity"), "keyword").limit(10)
    return report.frontier_gap_matrix(v.edges, fk, g.select(F.col("keyword").alias("gap"), "keyword", F.col("nearby_frontier").alias("home")))


def chart(spark, d):
    v = View(spark, d)
    years = [r.year for r in v.years.orderBy("year").collect()]
    return report.trend_chart(v.yearly, report.highlights(v.frontiers()), years)


def density(spark, d):
    v = View(spark, d)
    return v.density(v.fk()).select("keyword", F.round("density", 6).alias("density"), F.round("proximity", 6).alias("proximity"))


def marked(spark, d):
    v = View(spark, d)
    f = materialize(v.frontiers(), "frontiers")
    g = v.density(gaps.frontier_keywords(f)).select("keyword")
    return report.marked_nodes(v.edges, f, g).select("id", "value", "group", "in_gap", "border")


def inferred(v):
    return gaps.inferred_gaps(v.edges, v.fk())


def ways(spark, d):
    e = materialize(biblio.cooccurrence(basket(spark, d), 200, SPARSE), "edges")
    start = graph.both_ways(e).agg(F.min("node").alias("node"))
    return graph.distances(e, start, 12).select("node", F.col("distance").cast("int").alias("distance"))


def thresholds(spark, d):
    t = adaptive(quality.summary(basket(spark, d)))
    return t.select("n_papers", "n_keywords", "year_span", "cluster_size", "cluster_size_by_papers", "edge_weight", F.round("gamma", 6).alias("gamma"), "years_needed", F.round("proximity", 6).alias("proximity"), F.round("bridge_ratio", 6).alias("bridge_ratio"), "is_small", "is_short", "is_sparse", "is_very_sparse")


def text_quality(spark, d):
    """The documents as papers, those of one title but the first taken out."""
    p = docs(spark, d).withColumn("keywords", F.array("lang", "journal"))
    kept = materialize(dedup.keep_first(p.withColumn("t", T.normalize_title(F.col("title"))), "t", "paper_id").drop("t"), "kept")
    return quality.assess(kept, "journal", p.count() - kept.count())


def planted_vectors(spark, d):
    """The embeddings and, of each, one that lies a little beside it."""
    v = V.read(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    beside = F.transform("embedding", lambda x, i: x + 0.01 * (F.pmod(F.col("vec_id") + i + 1, F.lit(5)) - 2))
    return v.unionByName(v.select((F.col("vec_id") + 1_000_000).alias("vec_id"), beside.alias("embedding")))


def greedy(spark, d):
    """Documents as papers without a DOI: duplicates by title, the most complete one stays."""
    p = docs(spark, d).select(F.col("paper_id").cast("string").alias("id"), "title", "abstract", F.lit(None).cast("string").alias("doi"), F.array().cast("array<string>").alias("keywords"), F.col("paper_id").alias("ingest_seq"))
    kept, _ = dedup.deduplicate(p.withColumn("title", F.concat(F.col("title"), F.lit(" of the "), F.substring("title", 1, 1))), 1.0)
    return kept.select(F.col("ingest_seq").alias("paper_id"))


def chased(spark, d):
    """Orders as found papers: those new to the orders of the first half of the customers, by id and by a DOI of customer and year."""
    o = V.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat_ws("/", F.lit("10.1000"), F.year("o_orderdate"), "o_custkey").alias("doi"), "o_custkey", "o_orderpriority")
    known = o.filter("o_orderpriority = '1-URGENT'")
    return dedup.new_papers(o, known).select("id")


def with_view(f, weight=DENSE):
    return lambda s, d: f(View(s, d, weight))


def hops3(spark, d):
    e = materialize(biblio.cooccurrence(basket(spark, d), 200, SPARSE), "edges")
    start = graph.both_ways(e).agg(F.min("node").alias("node"))
    return graph.hops(e, start, 3).select("node", "hops")


def frontier_rows(f):
    return f.select("community", "label", F.array_join("top_keywords", "; ").alias("top_keywords"), "node_count", "avg_year", "avg_growth_rate", "max_burst_intensity", "cross_cluster_edges", "recency_norm", "growth_norm", "burst_norm", "cross_norm", "frontier_score")


def learned(v):
    p = graph.communities(v.edges)
    return frontier_rows(v.frontiers(p))


def orders_sized(spark, d):
    return V.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat_ws("-", F.year("o_orderdate"), "o_custkey").alias("doi"), "o_orderpriority")


def citations(spark, d):
    """Orders cite the customer's part numbers' first order: a toy citation graph over whole tables."""
    l = V.read(spark, d, "lineitem")
    e = l.select(F.col("l_orderkey").alias("citing"), F.col("l_partkey").alias("cited")).distinct()
    seeds = V.read(spark, d, "supplier").select(F.col("s_suppkey").alias("paper_id"))
    return dedup.expand_citations(e, seeds)


def fuzzy(spark, d):
    return dedup.fuzzy_title_dedup(docs(spark, d).select(F.col("paper_id").alias("id"), "title"), 0.85)


def incremental(spark, d):
    t = docs(spark, d)
    old, new = t.filter("year < 2020").drop("lang"), t.filter("year >= 2020")
    return old.unionByName(new, allowMissingColumns=True).groupBy("year").agg(F.count("*").alias("n"), F.count("lang").alias("n_lang"))


QUERIES = {
    "keyword_trends": lambda s, d: finite(biblio.top_trends(trends(s, d), 100)),
    "top_keywords": lambda s, d: biblio.top_trends(freq(s, d), 50),
    "keyword_freq": freq,
    "keyword_yearly": lambda s, d: biblio.keyword_yearly(basket(s, d)),
    "papers_per_year": lambda s, d: biblio.papers_per_year(basket(s, d)),
    "rising_keywords": labelled("rising"),
    "declining_keywords": labelled("declining"),
    "keyword_pivot": pivot,
    "cooccurrence": edges_of,
    "cooccurrence_raw": lambda s, d: biblio.cooccurrence(basket(s, d), 200, 2, distinct=False),
    "author_network": lambda s, d: biblio.author_network(basket(s, d)),
    "top_journals": lambda s, d: biblio.top_values(basket(s, d), "journal", 10),
    "citation_stats": lambda s, d: biblio.citation_stats(basket(s, d)),
    "corpus_summary": lambda s, d: biblio.corpus_summary(basket(s, d)),
    "quality_report": lambda s, d: quality.assess(basket(s, d)),
    "bursts": all_bursts,
    "recent_bursts": recent_bursts,
    "burst_list": burst_list,
    "temporal_gaps": temporal,
    "clean_text": lambda s, d: V.read(s, d, "pages").select("page_id", T.clean_text(F.col("html")).alias("clean")),
    "title_norm": lambda s, d: docs(s, d).select("paper_id", T.normalize_title(F.col("title")).alias("title_norm")),
    "normalize_author": lambda s, d: V.read(s, d, "supplier").select("s_suppkey", T.normalize_author(F.replace("s_name", F.lit("#"), F.lit(" "))).alias("author")),
    "extract_doi": lambda s, d: V.read(s, d, "orders").select("o_orderkey", T.extract_doi(F.concat(F.lit("see https://doi.org/10.1234/"), F.lower("o_orderpriority"), F.lit("."), F.col("o_orderkey"))).alias("doi")),
    "extract_year": lambda s, d: V.read(s, d, "orders").select("o_orderkey", T.extract_year(F.concat(F.lit("published "), F.date_format("o_orderdate", "dd/MM/yyyy"))).alias("year")),
    "hue": lambda s, d: V.read(s, d, "nation").select("n_nationkey", T.hue(F.col("n_nationkey")).alias("hue")),
    "completeness": lambda s, d: docs(s, d).select("paper_id", T.completeness(F.col("abstract"), F.col("journal"), F.array("lang")).alias("completeness")),
    "person": lambda s, d: V.read(s, d, "supplier").select("s_suppkey", T.person(F.substring_index("s_name", "#", 1), F.when(F.pmod("s_suppkey", F.lit(2)) == 0, F.substring_index("s_name", "#", -1))).alias("person")),
    "stem_keywords": lambda s, d: V.read(s, d, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).filter("w <> ''").distinct().select("w", T.stem(F.col("w")).alias("stem")),
    "normalize_keywords": lambda s, d: V.read(s, d, "part").select("p_partkey", T.normalize_keyword(F.concat_ws(" ", "p_name", "p_type")).alias("keyword")),
    "word_keywords": lambda s, d: keywords.word_keywords(V.read(s, d, "documents")),
    "tfidf_keywords": lambda s, d: keywords.tfidf_keywords(V.read(s, d, "documents")),
    "embedding_keywords": lambda s, d: keywords.embedding_keywords(docs(s, d).select("paper_id", "title"), id_col="paper_id", text_col="title"),
    "doi_dedup": lambda s, d: dedup.keep_first(orders_sized(s, d), "doi", "id", "o_orderpriority").select("id", "doi"),
    "exact_title_dedup": lambda s, d: dedup.keep_first(docs(s, d).select("paper_id", T.normalize_title(F.col("title")).alias("t")), "t", "paper_id").select("paper_id"),
    "fuzzy_title_dedup": fuzzy,
    "greedy_dedup": greedy,
    "embedding_pairs": lambda s, d: dedup.embedding_pairs(planted_vectors(s, d)).select("a", "b"),
    "embedding_dedup": lambda s, d: dedup.embedding_dedup(planted_vectors(s, d)),
    "node_degree": lambda s, d: graph.degrees(edges_of(s, d)),
    "graph_density": lambda s, d: graph.density(materialize(edges_of(s, d), "edges")),
    "hops_le_3": hops3,
    "weighted_distances": ways,
    "connected_components": lambda s, d: graph.components(biblio.cooccurrence(basket(s, d), 200, SPARSE)),
    "communities": lambda s, d: graph.communities(edges_of(s, d)),
    "frontiers": with_view(learned),
    "frontiers_given_partition": with_view(lambda v: frontier_rows(v.frontiers())),
    "density_gaps": density,
    "bridge_gaps": with_view(lambda v: gaps.bridge_gaps(v.edges, v.fk()).select("f1", "f2", "shared", F.round("ratio", 6).alias("ratio"), F.round("potential", 6).alias("potential"))),
    "semantic_gaps": with_view(lambda v: gaps.semantic_gaps(v.edges, v.fk(), score_over=0.0), SPARSE),
    "semantic_gaps_by_weight": with_view(lambda v: gaps.semantic_gaps(v.edges, v.fk(), most=10, score_over=0.0, by_weight=True).withColumn("distance", F.col("distance").cast("int")), SPARSE),
    "broker_gaps": with_view(lambda v: gaps.broker_gaps(v.edges, v.fk())),
    "inferred_gaps": with_view(inferred, SPARSE),
    "gaps_ranked": ranked,
    "vis_edges": lambda s, d: report.vis_edges(edges_of(s, d)),
    "gap_counts": lambda s, d: gaps.gap_counts(ranked(s, d)),
    "marked_nodes": marked,
    "adaptive_thresholds": thresholds,
    "quality_of_texts": text_quality,
    "vis_nodes": with_view(lambda v: report.vis_nodes(v.edges, v.partition)),
    "trend_chart": chart,
    "frontier_gap_matrix": matrix,
    "year_filter": lambda s, d: basket(s, d).filter(T.year_between(F.col("year"), T.years_of("1996\u20131998"))).select("paper_id", "year", F.size("keywords").alias("n_keywords")),
    "incremental_union": incremental,
    "citation_expand": citations,
    "citation_new": chased,
    "paper_rows": lambda s, d: report.paper_rows(basket(s, d).select(F.col("paper_id").alias("id"), F.col("journal").alias("title"), F.lit(None).cast("string").alias("doi"), "year", "authors", "journal", "keywords")).select("id", "doi", "year", "journal"),
    "labelled_quality": lambda s, d: V.read(s, d, "documents").join(V.read(s, d, "labels"), "doc_id").groupBy("lang", "quality").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")),
}

# ---- SQL ---------------------------------------------------------------------------------------------------------

OCC = """occ AS (SELECT DISTINCT l_orderkey AS paper_id, p_name || ' ' || lower(p_brand) AS keyword, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
FREQ = "freq AS (SELECT keyword, count(*) AS total_count FROM occ GROUP BY 1)"
YEARLY = "yearly AS (SELECT keyword, year, count(*) AS n FROM occ GROUP BY 1, 2)"
YEARS = "years AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_papers FROM orders WHERE year(o_orderdate) IN (SELECT year FROM occ) GROUP BY 1)"
AXIS = "axis AS (SELECT year, n_papers, row_number() OVER (ORDER BY year) AS i, count(*) OVER () AS k FROM years)"
TRENDS = """p AS (SELECT max(k) AS ny, greatest(1, coalesce(sum(n_papers) FILTER (i <= 2), 0)) AS pe, greatest(1, coalesce(sum(n_papers) FILTER (i > k - 2), 0)) AS pl, greatest(1, coalesce(sum(n_papers) FILTER (i > k - 4 AND i <= k - 2), 0)) AS pp FROM axis),
r AS (SELECT keyword, coalesce(sum(n) FILTER (i <= 2), 0) / any_value(pe) AS early, coalesce(sum(n) FILTER (i > k - 2), 0) / any_value(pl) AS late, coalesce(sum(n) FILTER (i > k - 4 AND i <= k - 2), 0) / any_value(pp) AS prev, any_value(ny) AS ny FROM yearly JOIN axis USING (year), p GROUP BY 1),
trends AS (SELECT keyword, total_count, CASE WHEN ny < 4 THEN 'insufficient_data' WHEN late > 1.3 * early THEN 'rising' WHEN late < 0.7 * early THEN 'declining' ELSE 'stable' END AS trend,
  CASE WHEN ny < 4 THEN NULL WHEN late = 0 THEN -1.0 WHEN prev = 0 THEN NULL ELSE round(sqrt(late / prev) - 1, 3) END AS cagr_3yr FROM freq JOIN r USING (keyword))"""
TOP = "top AS (SELECT keyword FROM freq ORDER BY total_count DESC, keyword LIMIT 200)"
EDGES = f"""{TOP}, e0 AS (SELECT a.keyword AS keyword_a, b.keyword AS keyword_b, count(*) AS weight, min(a.year) AS year_range_start, max(a.year) AS year_range_end
  FROM (SELECT * FROM occ SEMI JOIN top USING (keyword)) a JOIN (SELECT * FROM occ SEMI JOIN top USING (keyword)) b ON a.paper_id = b.paper_id AND a.keyword < b.keyword GROUP BY 1, 2)"""
BASE = f"WITH RECURSIVE {OCC}, {FREQ}, {YEARLY}, {YEARS}, {AXIS}, {TRENDS}, {EDGES}, edges AS (SELECT * FROM e0 WHERE weight >= {{w}})"
BURSTS = """tot AS (SELECT keyword, sum(n) AS total FROM src GROUP BY 1),
grid AS (SELECT tot.keyword, axis.year, i, coalesce(n, 0) AS n, greatest(total / k, 0.5) AS base FROM tot CROSS JOIN axis LEFT JOIN src ON src.keyword = tot.keyword AND src.year = axis.year WHERE k >= 3),
isl AS (SELECT *, sum(CASE WHEN n >= 0.5 * base THEN 0 ELSE 1 END) OVER (PARTITION BY keyword ORDER BY i) AS island FROM grid),
st AS (SELECT *, min(CASE WHEN n >= base AND n >= 2 THEN i END) OVER (PARTITION BY keyword, island) AS first_start FROM isl WHERE n >= 0.5 * base),
bursts AS (SELECT keyword, min(year) AS burst_start, max(year) AS burst_end, round(max(n) / any_value(base), 2) AS intensity FROM st WHERE i >= first_start GROUP BY keyword, island)"""
GRAPH = """both_ways AS (SELECT keyword_a AS node, keyword_b AS other, weight FROM edges UNION ALL SELECT keyword_b, keyword_a, weight FROM edges),
part_ AS (SELECT DISTINCT node, split_part(node, ' ', 1) AS community FROM both_ways)"""
FRONT = f"""t100 AS (SELECT * FROM trends ORDER BY total_count DESC, keyword LIMIT 100),
src AS (SELECT yearly.* FROM yearly SEMI JOIN t100 USING (keyword)), {BURSTS},
my AS (SELECT keyword, sum(year * n) / sum(n) AS mean_year FROM src GROUP BY 1),
cm AS (SELECT community, count(*) AS node_count, avg(mean_year) AS avg_year, coalesce(CAST(sum(CAST(cagr_3yr AS DECIMAL(18, 3))) FILTER (cagr_3yr >= 0) AS DOUBLE) / count(*) FILTER (cagr_3yr >= 0), 0) + 1e-9 AS avg_growth FROM part_ LEFT JOIN my ON node = my.keyword LEFT JOIN t100 ON node = t100.keyword GROUP BY 1),
bu AS (SELECT community, max(intensity) AS max_burst, avg(intensity) AS mean_burst FROM part_ JOIN bursts ON node = keyword GROUP BY 1),
bw AS (SELECT b.*, x.community AS c1, y.community AS c2 FROM both_ways b JOIN part_ x ON b.node = x.node JOIN part_ y ON b.other = y.node),
cr AS (SELECT c1 AS community, count(*) AS cross_edges FROM bw WHERE c1 <> c2 GROUP BY 1),
deg AS (SELECT part_.community, part_.node, coalesce(d, 0) AS d FROM part_ LEFT JOIN (SELECT node, sum(weight) AS d FROM bw WHERE c1 = c2 GROUP BY 1) q ON part_.node = q.node),
rk AS (SELECT *, row_number() OVER (PARTITION BY community ORDER BY d DESC, node) AS rank FROM deg),
tp AS (SELECT community, string_agg(node, '; ' ORDER BY rank) AS top_keywords, string_agg(node, ' / ' ORDER BY rank) FILTER (rank <= 3) AS label FROM rk WHERE rank <= 5 GROUP BY 1),
fn AS (SELECT cm.*, coalesce(max_burst, 0) AS mb, coalesce(mean_burst, 0) AS ab, coalesce(cross_edges, 0) AS ce, (SELECT min(year) FROM years) AS y0, (SELECT max(year) FROM years) AS y1, top_keywords, label
  FROM cm LEFT JOIN bu USING (community) LEFT JOIN cr USING (community) JOIN tp USING (community) WHERE node_count >= 2 AND avg_year IS NOT NULL),
fs AS (SELECT *, CASE WHEN y1 > y0 THEN least(1, greatest(0, (avg_year - y0) / (y1 - y0))) ELSE 0.5 END AS rn, least(1, greatest(0, avg_growth)) AS gn, least(1, greatest(0, (0.7 * mb + 0.3 * ab) / 10)) AS bn, least(1, greatest(0, ce / greatest(1, node_count) / 5)) AS cn FROM fn),
fr AS (SELECT community, label, top_keywords, node_count, round(avg_year, 1) AS avg_year, round(avg_growth, 3) AS avg_growth_rate, round(mb, 2) AS max_burst_intensity, ce AS cross_cluster_edges, round(rn, 3) AS recency_norm, round(gn, 3) AS growth_norm, round(bn, 3) AS burst_norm, round(cn, 3) AS cross_norm,
  round((0.35 * bn + 0.30 * rn + 0.25 * gn + 0.10 * cn) * CASE WHEN node_count > 60 THEN 0.5 WHEN node_count > 30 THEN 0.8 ELSE 1 END, 3) AS frontier_score FROM fs),
fk AS (SELECT fr.community, frontier_score AS s, avg_growth_rate AS g, node FROM fr JOIN rk USING (community) WHERE rank <= 5)"""
GENERIC = ", ".join(f"'{w}'" for w in lexicon.GENERIC)
NAMES = f"length(x.node) >= 4 AND x.node NOT IN ({GENERIC}) AND (strpos(x.node, ' ') > 0 OR length(x.node) >= 6)"
PAIRS = """fc AS (SELECT community, count(*) AS n, any_value(s) AS s, any_value(g) AS g FROM fk GROUP BY 1),
fp AS (SELECT a.community AS f1, b.community AS f2, a.n AS n1, b.n AS n2, a.s AS s1, b.s AS s2, a.g AS g1, b.g AS g2 FROM fc a JOIN fc b ON a.community < b.community),
dr AS (SELECT x.community AS f1, y.community AS f2, count(*) AS direct FROM both_ways b JOIN fk x ON b.node = x.node JOIN fk y ON b.other = y.node WHERE x.community < y.community GROUP BY 1, 2)"""
DENSITY = f"""nr AS (SELECT b.node, community, avg(weight) AS w FROM both_ways b JOIN fk ON b.other = fk.node GROUP BY 1, 2),
bs AS (SELECT node, max(w) AS w, arg_min(community, (-w, community)) AS home FROM nr GROUP BY 1),
wd AS (SELECT node, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weighted_degree FROM both_ways GROUP BY 1),
dg AS (SELECT x.node AS keyword, total_count / (SELECT count(*) FROM orders) AS density, least(1, w / greatest(1, total_count) / greatest(1, weighted_degree)) AS proximity, home
  FROM wd x JOIN freq ON x.node = freq.keyword JOIN bs ON bs.node = x.node WHERE x.node NOT IN (SELECT node FROM fk) AND total_count <= 0.1 * (SELECT count(*) FROM orders) AND {NAMES} AND least(1, w / greatest(1, total_count) / greatest(1, weighted_degree)) > {PROXIMITY})"""
BRIDGE = """nb AS (SELECT DISTINCT community, other FROM both_ways b JOIN fk ON b.node = fk.node),
sh AS (SELECT a.community AS f1, b.community AS f2, count(*) AS shared FROM nb a JOIN nb b USING (other) WHERE a.community < b.community GROUP BY 1, 2),
br0 AS (SELECT fp.*, coalesce(shared, 0) AS shared, coalesce(direct, 0) / (n1 * n2) AS ratio, coalesce(shared, 0) / (n1 + n2) AS overlap FROM fp LEFT JOIN dr USING (f1, f2) LEFT JOIN sh USING (f1, f2)),
br AS (SELECT *, overlap * (1 - ratio) AS potential FROM br0 WHERE ratio < CASE WHEN n1 * n2 > 30 THEN 0.35 ELSE 0.25 END AND overlap > 0)"""
HOPS = """hp AS (SELECT node AS source, node, 0 AS hops FROM st0 UNION SELECT source, other, hops + 1 FROM hp JOIN both_ways b ON hp.node = b.node WHERE hops < {n})"""
TEMPORAL = """td AS (SELECT keyword, coalesce(sum(n) FILTER (i <= 3), 0) AS early, coalesce(sum(n) FILTER (i > k - 3), 0) AS late, arg_min(year, (-n, year)) AS peak_year, max(n) AS peak_count FROM yearly JOIN axis USING (year) WHERE k >= 6 GROUP BY 1)"""
RANKED = """every AS (
SELECT 'density' AS gap_type, dg.keyword AS label, 0.35 * (1 - least(1, 5 * density)) + 0.3 * proximity + 0.2 * CASE WHEN cagr_3yr IS NULL OR cagr_3yr < -1 THEN 0.3 ELSE least(1, greatest(0, cagr_3yr)) END + 0.075 AS s FROM dg LEFT JOIN trends USING (keyword)
UNION ALL SELECT 'bridge', f1 || ' <-> ' || f2, 0.3 * (1 - least(1, 3 * ratio)) + 0.25 * (s1 + s2) / 2 + 0.2 * potential + 0.15 * least(1, (g1 + g2) / 2) + 0.05 FROM br
UNION ALL SELECT 'temporal', keyword, 0.35 * (1 - least(1, 2 * round(late / early, 3))) + 0.25 * least(1, ((SELECT max(year) FROM years) - peak_year) / 10) + 0.16 FROM td WHERE early >= 10 AND late <= 0.3 * early),
rs AS (SELECT gap_type, label, round(s, 3) AS gap_score FROM every)"""
TITLE = r"trim(regexp_replace(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\p{L}\p{M}\p{N}\p{Pc}\s]', '', 'g'), '\s+', ' ', 'g'))"
WORDS_SQL = "list_filter(string_split_regex(lower({t}), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '')"
DOCS_WORDS = f"""wl AS (SELECT doc_id, {WORDS_SQL.format(t="coalesce(text, '')")} AS ws FROM documents),
wd AS (SELECT doc_id, unnest(ws) AS keyword, unnest(generate_series(1, len(ws))) AS pos FROM wl),
w4 AS (SELECT * FROM wd WHERE regexp_full_match(keyword, '[a-z]{{4,}}')),
cw AS (SELECT keyword FROM (SELECT DISTINCT doc_id, keyword FROM w4) GROUP BY 1 HAVING count(*) > 0.2 * (SELECT count(*) FROM documents))"""


def sql_clean(x):
    """clean_text: RE2 knows word edges in ASCII only, so edges are written out; what one takes with it the second pass finds."""
    edge, other = r"(^|[^\p{L}\p{M}\p{N}\p{Pc}])", r"($|[^\p{L}\p{M}\p{N}\p{Pc}])"
    x = f"regexp_replace({x}, '</?[a-z]+[^>]*>', ' ', 'g')"
    x = f"regexp_replace({x}, '{edge}10\\.\\d{{4,}}/[^\\s]+', '\\1 ', 'g')"
    x = f"regexp_replace({x}, 'https?://\\S+', ' ', 'g')"
    for body in ("\\d+", "[a-z]"):
        for _ in range(2):
            x = f"regexp_replace({x}, '{edge}{body}{other}', '\\1 \\2', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


LEMMA = "CASE " + " ".join(f"WHEN {{w}} = '{k}' THEN '{v}'" for k, v in lexicon.LEMMAS.items()) + " WHEN {w} IN (" + ", ".join(f"'{x}'" for x in lexicon.UNSTEMMED) + ") THEN {w} ELSE {rest} END"
SINGULAR = "CASE WHEN {w} LIKE '%es' AND length({w}) > 4 AND {w} NOT LIKE '%sses' THEN left({w}, length({w}) - 2) WHEN {w} LIKE '%s' AND {w} NOT LIKE '%ss' AND length({w}) > 3 THEN left({w}, length({w}) - 1) ELSE {w} END"


def sql_stem(w):
    s = SINGULAR.format(w=w)
    return LEMMA.format(w=w, rest=f"CASE WHEN ({s}) LIKE '%ing' AND length({s}) > 6 THEN left({s}, length({s}) - 3) ELSE {s} END")


def sql_normalize(x):
    known = lexicon.synonym_map()
    table = lambda k, rest: "CASE " + " ".join(f"WHEN {k} = '{v}' THEN '{c}'" for v, c in known.items()) + f" ELSE {rest} END"
    stop = ", ".join(f"'{w}'" for w in lexicon.STOPWORDS)
    k = f"trim(regexp_replace(regexp_replace(lower(trim({x})), '[^a-z0-9\\s\\-]', '', 'g'), '\\s+', ' ', 'g'))"
    stemmed = f"CASE WHEN strpos(k, ' ') > 0 THEN array_to_string(list_transform(list_filter(string_split(k, ' '), lambda w: w NOT IN ({stop})), lambda w: {sql_stem('w')}), ' ') ELSE {sql_stem('k')} END"
    return k, stemmed, f"CASE WHEN length(k) < 2 THEN NULL WHEN k IN ({', '.join(repr(v) for v in known)}) THEN {table('k', 'NULL')} WHEN k IN ({stop}) THEN NULL ELSE nullif({table('st', 'st')}, '') END"


B2, B4 = BASE.format(w=DENSE), BASE.format(w=SPARSE)
AUTHORS = "au AS (SELECT l_orderkey AS p, s_name AS a, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, p_name || ' ' || lower(p_brand), s_name) AS i FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"
RAW = "rw AS (SELECT l_orderkey AS p, p_name || ' ' || lower(p_brand) AS k, CAST(year(o_orderdate) AS INTEGER) AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"
STOP = ", ".join(f"'{w}'" for w in lexicon.STOPWORDS)

PLANTED = "e0 AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), e AS (SELECT * FROM e0 UNION ALL SELECT vec_id + 1000000, list_transform(v, lambda x, i: x + 0.01 * ((vec_id + i) % 5 - 2)) FROM e0)"
VERDICT = """w AS (SELECT *, concat_ws('; ', CASE WHEN n_papers < 30 THEN 'few papers' END, CASE WHEN year_span < 5 THEN 'short span' END, CASE WHEN n_keywords < 50 THEN 'few keywords' END, CASE WHEN abstract_pct < 50 THEN 'few abstracts' END, CASE WHEN dedup_pct > 30 THEN 'many duplicates' END, CASE WHEN share > 0.8 THEN 'one source dominates' END) AS warnings FROM q)
SELECT n_papers, year_span, n_keywords, CAST(abstract_pct AS DOUBLE) AS abstract_pct, CAST(dedup_pct AS DOUBLE) AS dedup_pct, round(share, 4) AS source_share, warnings, CASE WHEN warnings = '' THEN 'good' WHEN len(string_split(warnings, ';')) <= 2 THEN 'fair' ELSE 'poor' END AS verdict FROM w"""
NORMALIZE = sql_normalize("p_name || ' ' || p_type")
BROKERS = f"""x AS (SELECT node, sum(weight) AS wdeg FROM both_ways GROUP BY 1), nn AS (SELECT b.node, count(DISTINCT community) AS n_frontiers FROM both_ways b JOIN fk ON b.other = fk.node WHERE b.node NOT IN (SELECT node FROM fk) GROUP BY 1),
bk AS (SELECT x.node AS keyword, n_frontiers, round(least(0.85, 0.4 + least(0.25, 0.08 * (n_frontiers - 2)) + 0.2 * wdeg / (SELECT max(wdeg) FROM x)), 3) AS score FROM x JOIN nn ON nn.node = x.node WHERE n_frontiers >= 2 AND {NAMES})"""

ORACLE = {
    "keyword_trends": f"{B2} SELECT * FROM trends ORDER BY total_count DESC, keyword LIMIT 100",
    "keyword_freq": f"WITH {OCC}, {FREQ} SELECT * FROM freq",
    "keyword_yearly": f"WITH {OCC}, {YEARLY} SELECT * FROM yearly",
    "papers_per_year": f"WITH {OCC}, {YEARS} SELECT * FROM years",
    "rising_keywords": f"{B2} SELECT * FROM trends WHERE trend = 'rising' ORDER BY total_count DESC, keyword LIMIT 20",
    "declining_keywords": f"{B2} SELECT * FROM trends WHERE trend = 'declining' ORDER BY total_count DESC, keyword LIMIT 20",
    "keyword_pivot": f"WITH {OCC} SELECT keyword, " + ", ".join(f"count(*) FILTER (year = {y}) AS y{y}" for y in range(1995, 2002)) + " FROM occ GROUP BY 1",
    "cooccurrence": f"{B2} SELECT * FROM edges",
    "cooccurrence_raw": f"WITH {RAW}, tk AS (SELECT k FROM rw GROUP BY 1 ORDER BY count(*) DESC, k LIMIT 200), r2 AS (SELECT * FROM rw SEMI JOIN tk USING (k)) SELECT least(a.k, b.k) AS keyword_a, greatest(a.k, b.k) AS keyword_b, count(*) AS weight, min(a.y) AS year_range_start, max(a.y) AS year_range_end FROM r2 a JOIN r2 b ON a.p = b.p AND a.i < b.i GROUP BY 1, 2 HAVING count(*) >= 2",
    "author_network": f"WITH {AUTHORS} SELECT least(x.a, y.a) AS author_a, greatest(x.a, y.a) AS author_b, count(*) AS weight FROM au x JOIN au y ON x.p = y.p AND x.i < y.i GROUP BY 1, 2 HAVING count(*) >= 2",
    "top_journals": "SELECT o_orderpriority AS journal, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "citation_stats": "WITH c AS (SELECT CAST(trunc(o_totalprice / 1000) AS INTEGER) AS c FROM orders) SELECT round(avg(c), 1) AS citations_mean, median(c) AS citations_median, max(c) AS citations_max FROM c WHERE c <> 0",
    "corpus_summary": f"WITH {OCC} SELECT count(*) AS total_papers, CAST(min(year(o_orderdate)) AS INTEGER) AS year_min, CAST(max(year(o_orderdate)) AS INTEGER) AS year_max, (SELECT count(DISTINCT paper_id) FROM occ) AS n_with_keywords, (SELECT count(*) FROM occ) AS n_keyword_uses FROM orders",
    "quality_report": f"WITH {OCC}, q AS (SELECT (SELECT count(*) FROM orders) AS n_papers, (SELECT CAST(max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS INTEGER) FROM orders) AS year_span, (SELECT count(DISTINCT keyword) FROM occ) AS n_keywords, 0.0::DOUBLE AS abstract_pct, 0.0::DOUBLE AS dedup_pct, (SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)) AS share), {VERDICT}",
    "quality_of_texts": f"WITH t AS (SELECT *, {TITLE} AS t FROM documents), kept AS (SELECT * FROM t QUALIFY t IS NULL OR row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1), q AS (SELECT (SELECT count(*) FROM kept) AS n_papers, (SELECT CAST(max(2015 + (doc_id * 7) % 11) - min(2015 + (doc_id * 7) % 11) + 1 AS INTEGER) FROM kept) AS year_span, (SELECT count(DISTINCT k) FROM (SELECT lang AS k FROM kept UNION ALL SELECT source FROM kept)) AS n_keywords, (SELECT round(100.0 * count(*) FILTER (length(text) > 50) / count(*), 1) FROM kept) AS abstract_pct, (SELECT round(100.0 * ((SELECT count(*) FROM documents) - (SELECT count(*) FROM kept)) / (SELECT count(*) FROM documents), 1)) AS dedup_pct, (SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM kept GROUP BY source)) AS share), {VERDICT}",
    "adaptive_thresholds": f"WITH {OCC}, q AS (SELECT (SELECT count(*) FROM orders) AS n_papers, (SELECT count(DISTINCT keyword) FROM occ) AS n_keywords, (SELECT CAST(max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS INTEGER) FROM orders) AS year_span), f AS (SELECT *, greatest(0.3, least(1.0, n_papers / 100)) AS sz, greatest(0.2, least(1.0, year_span / 10)) AS sp FROM q) SELECT n_papers, n_keywords, year_span, CAST(least(greatest(2, floor(0.05 * n_papers)), greatest(2, floor(0.05 * n_keywords))) AS INTEGER) AS cluster_size, CAST(greatest(2, floor(0.05 * n_papers)) AS INTEGER) AS cluster_size_by_papers, CAST(greatest(1, floor(0.02 * n_papers)) AS INTEGER) AS edge_weight, round(CAST(2 - sp AS DOUBLE), 6) AS gamma, CAST(greatest(3, floor(round(6 * (1 - sp), 9))) AS INTEGER) AS years_needed, round(CAST(greatest(0.2, sz / 2) AS DOUBLE), 6) AS proximity, round(CAST(least(0.5, 0.2 / sz) AS DOUBLE), 6) AS bridge_ratio, n_papers < 30 AS is_small, year_span < 5 AS is_short, n_keywords < 50 AS is_sparse, n_keywords < 30 AS is_very_sparse FROM f",
    "top_keywords": f"WITH {OCC}, {FREQ} SELECT * FROM freq ORDER BY total_count DESC, keyword LIMIT 50",
    "burst_list": f"WITH {OCC}, {YEARLY}, {YEARS}, {AXIS}, src AS (SELECT * FROM yearly), {BURSTS} SELECT b.keyword, CAST(any_value(total) AS BIGINT) AS total, string_agg(burst_start || '-' || burst_end, ';' ORDER BY burst_start) AS bursts FROM bursts b JOIN tot ON tot.keyword = b.keyword GROUP BY 1",
    "clean_text": f"SELECT page_id, {sql_clean('html')} AS clean FROM pages",
    "normalize_keywords": "WITH a AS (SELECT p_partkey, " + NORMALIZE[0] + " AS k FROM part), b AS (SELECT *, " + NORMALIZE[1] + " AS st FROM a) SELECT p_partkey, " + NORMALIZE[2] + " AS keyword FROM b",
    "hue": "SELECT n_nationkey, CAST((n_nationkey * 137) % 360 AS INTEGER) AS hue FROM nation",
    "completeness": "SELECT doc_id AS paper_id, CAST(length(coalesce(text, '')) + length(coalesce(source, '')) + 1 AS INTEGER) AS completeness FROM documents",
    "person": "SELECT s_suppkey, split_part(s_name, '#', 1) || CASE WHEN s_suppkey % 2 = 0 THEN ', ' || split_part(s_name, '#', -1) ELSE '' END AS person FROM supplier",
    "tfidf_keywords": f"WITH {DOCS_WORDS}, tw AS (SELECT doc_id, list_filter({WORDS_SQL.format(t=sql_clean("coalesce(text, '')"))}, lambda w: length(w) >= 2 AND w NOT IN ({STOP})) AS ws FROM documents), tt AS (SELECT doc_id, unnest(ws) AS keyword FROM tw UNION ALL SELECT doc_id, unnest(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) FROM tw), tf AS (SELECT doc_id, keyword, count(*) AS tf FROM tt GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM documents), vc AS (SELECT keyword, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) <= 0.8 * (SELECT n FROM n) ORDER BY sum(tf) DESC, keyword LIMIT 500), x AS (SELECT doc_id, keyword, tf * (ln((1 + (SELECT n FROM n)) / (1 + df)) + 1) AS x FROM tf JOIN vc USING (keyword)), sc AS (SELECT doc_id, keyword, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS score FROM x), r1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, keyword) AS place FROM sc), r2 AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, keyword) AS INTEGER) AS rank FROM r1 WHERE place <= 10 AND score > 0 AND length(keyword) >= 3 AND keyword NOT IN (SELECT keyword FROM cw) AND NOT regexp_full_match(keyword, '[0-9 ]+')) SELECT doc_id, keyword, score, rank FROM r2 WHERE rank <= 5",
    "greedy_dedup": f"SELECT min_by(doc_id, (-length(coalesce(text, '')), doc_id)) AS paper_id FROM documents GROUP BY {TITLE.replace('split_part(text, chr(10), 1)', "(split_part(text, chr(10), 1) || ' of the ' || substr(split_part(text, chr(10), 1), 1, 1))")}",
    "weighted_distances": f"{B4}, {GRAPH}, st0 AS (SELECT min(node) AS node FROM both_ways), wp AS (SELECT node, CAST(0 AS BIGINT) AS d FROM st0 UNION SELECT other, wp.d + weight FROM wp JOIN both_ways b ON wp.node = b.node WHERE wp.d + weight <= 12) SELECT node, CAST(min(d) AS INTEGER) AS distance FROM wp GROUP BY 1",
    "semantic_gaps_by_weight": f"{B4}, {GRAPH}, {FRONT}, {PAIRS}, wp AS (SELECT DISTINCT node AS source, node, CAST(0 AS BIGINT) AS d FROM fk UNION SELECT source, other, wp.d + weight FROM wp JOIN both_ways b ON wp.node = b.node WHERE wp.d + weight <= 10), ds AS (SELECT x.community AS f1, y.community AS f2, min(d) AS distance FROM wp JOIN fk x ON source = x.node JOIN fk y ON wp.node = y.node WHERE x.community < y.community AND source <> wp.node GROUP BY 1, 2) SELECT f1, f2, CAST(distance AS INTEGER) AS distance, round(least(0.85, (s1 + s2) / 2 / greatest(1, distance)), 3) AS score FROM fp ANTI JOIN dr USING (f1, f2) JOIN ds USING (f1, f2) ORDER BY score DESC, f1, f2 LIMIT 10",
    "inferred_gaps": f"{B4}, {GRAPH}, {FRONT}, {PAIRS}, {BROKERS}, st0 AS (SELECT DISTINCT node FROM fk), {HOPS.format(n=3)}, ds AS (SELECT x.community AS f1, y.community AS f2, min(hops) AS distance FROM hp JOIN fk x ON source = x.node JOIN fk y ON hp.node = y.node WHERE x.community < y.community AND hops > 0 GROUP BY 1, 2), ev AS (SELECT 'density' AS gap_type, 'Broker: ' || keyword AS label, score AS gap_score, CASE WHEN n_frontiers >= 3 THEN 'high' ELSE 'medium' END AS opportunity FROM bk UNION ALL SELECT 'bridge', 'Bridge: ' || f1 || ' <-> ' || f2, round(0.5 + 0.15 / greatest(1, distance), 3), 'medium' FROM fp ANTI JOIN dr USING (f1, f2) JOIN ds USING (f1, f2)) SELECT CAST(row_number() OVER (ORDER BY gap_score DESC, gap_type, label) AS INTEGER) AS rank, * FROM ev ORDER BY gap_score DESC, gap_type, label LIMIT 20",
    "gap_counts": f"{B2}, {GRAPH}, {FRONT}, {PAIRS}, {DENSITY}, {BRIDGE}, {TEMPORAL}, {RANKED} SELECT gap_type, count(*) AS n FROM (SELECT * FROM rs ORDER BY gap_score DESC, gap_type, label LIMIT 20) GROUP BY 1",
    "marked_nodes": f"{B2}, {GRAPH}, {FRONT}, {DENSITY}, fo AS (SELECT community, label, row_number() OVER (ORDER BY frontier_score DESC, community) AS place FROM fr), ow AS (SELECT node, arg_min(label, place) AS label FROM fo JOIN fk USING (community) GROUP BY 1), nf AS (SELECT node, sum(weight) AS f FROM both_ways GROUP BY 1) SELECT nf.node AS id, round(greatest(5, least(40, 5 + 8 * ln(f + 1))), 1) AS value, coalesce(label, 'other') AS \"group\", dg.keyword IS NOT NULL AS in_gap, CASE WHEN dg.keyword IS NOT NULL THEN 3 WHEN label IS NOT NULL THEN 2 ELSE 1 END AS border FROM nf LEFT JOIN ow ON ow.node = nf.node LEFT JOIN dg ON dg.keyword = nf.node",
    "frontier_gap_matrix": f"{B2}, {GRAPH}, {FRONT}, {DENSITY}, g10 AS (SELECT keyword, home FROM dg ORDER BY proximity DESC, keyword LIMIT 10), sz AS (SELECT community, count(*) AS n FROM fk GROUP BY 1 ORDER BY max(s) DESC, community LIMIT 10), ov AS (SELECT keyword, community, count(*) AS overlap FROM g10 JOIN (SELECT DISTINCT node, other FROM both_ways) b ON b.node = g10.keyword JOIN fk ON fk.node = b.other GROUP BY 1, 2) SELECT g10.keyword AS gap, sz.community AS frontier, round(greatest(CASE WHEN home = sz.community THEN 0.8 ELSE 0.0 END, least(1.0, coalesce(overlap, 0) / n)), 3) AS relevance FROM g10 CROSS JOIN sz LEFT JOIN ov ON ov.keyword = g10.keyword AND ov.community = sz.community",
    "citation_new": "WITH o AS (SELECT o_orderkey AS id, '10.1000/' || year(o_orderdate) || '/' || o_custkey AS doi, o_orderpriority = '1-URGENT' AS known FROM orders) SELECT id FROM o WHERE NOT known AND doi NOT IN (SELECT doi FROM o WHERE known)",
    "paper_rows": "SELECT o_orderkey AS id, '' AS doi, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS journal FROM orders ORDER BY o_orderkey LIMIT 200",
    "bursts": f"WITH {OCC}, {YEARLY}, {YEARS}, {AXIS}, src AS (SELECT * FROM yearly), {BURSTS} SELECT * FROM bursts",
    "recent_bursts": f"WITH {OCC}, {YEARLY}, {YEARS}, {AXIS}, src AS (SELECT * FROM yearly), {BURSTS} SELECT keyword, max(burst_end) AS last_end, count(*) AS n_bursts FROM bursts GROUP BY 1 HAVING max(burst_end) >= (SELECT min(year) FROM (SELECT year FROM years ORDER BY year DESC LIMIT 2))",
    "temporal_gaps": f"WITH {OCC}, {YEARLY}, {YEARS}, {AXIS}, {TEMPORAL} SELECT keyword, CAST(early AS BIGINT) AS early, CAST(late AS BIGINT) AS late, round(late / early, 3) AS decline_ratio, peak_year, peak_count FROM td WHERE early >= 10 AND late <= 0.3 * early",
    "title_norm": f"SELECT doc_id AS paper_id, {TITLE} AS title_norm FROM documents",
    "normalize_author": "SELECT s_suppkey, split_part(replace(s_name, '#', ' '), ' ', 2) || ', ' || split_part(replace(s_name, '#', ' '), ' ', 1) AS author FROM supplier",
    "extract_doi": "SELECT o_orderkey, regexp_extract('10.1234/' || lower(o_orderpriority) || '.' || o_orderkey, '(?i)(10\\.\\d{4,9}/[-._;()/:A-Z0-9]+)', 1) AS doi FROM orders",
    "extract_year": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
    "stem_keywords": f"WITH w AS (SELECT DISTINCT w FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM documents) WHERE w <> '') SELECT w, {sql_stem('w')} AS stem FROM w",
    "word_keywords": f"WITH {DOCS_WORDS}, c AS (SELECT doc_id, keyword, count(*) AS n, min(pos) AS f FROM w4 WHERE keyword NOT IN (SELECT keyword FROM cw) GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS INTEGER) AS rank FROM c) SELECT doc_id, keyword, n, rank FROM r WHERE rank <= 5",
    "doi_dedup": "SELECT id, doi FROM (SELECT o_orderkey AS id, year(o_orderdate) || '-' || o_custkey AS doi, row_number() OVER (PARTITION BY year(o_orderdate), o_custkey ORDER BY length(o_orderpriority) DESC, o_orderkey) AS r FROM orders) WHERE r = 1",
    "exact_title_dedup": f"SELECT min(doc_id) AS paper_id FROM documents GROUP BY {TITLE}",
    "embedding_pairs": f"WITH {PLANTED} SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) > 0.95",
    "embedding_dedup": f"WITH {PLANTED} SELECT y.vec_id AS removed, min(x.vec_id) AS kept FROM e x JOIN e y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) > 0.95 AND x.vec_id < 1000000 GROUP BY 1",
    "node_degree": f"{B2}, {GRAPH} SELECT node, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weighted_degree FROM both_ways GROUP BY 1",
    "graph_density": f"{B2}, {GRAPH} SELECT n_nodes, n_edges, round(n_edges / greatest(1, n_nodes * (n_nodes - 1) / 2), 4) AS density FROM (SELECT count(DISTINCT node) AS n_nodes, count(*) // 2 AS n_edges FROM both_ways)",
    "hops_le_3": f"{B4}, {GRAPH}, st0 AS (SELECT min(node) AS node FROM both_ways), {HOPS.format(n=3)} SELECT node, CAST(min(hops) AS INTEGER) AS hops FROM hp GROUP BY 1",
    "connected_components": f"{B4}, {GRAPH}, cc AS (SELECT node AS start, node FROM part_ UNION SELECT start, other FROM cc JOIN both_ways b ON cc.node = b.node) SELECT node, min(start) AS component FROM cc GROUP BY 1",
    "frontiers_given_partition": f"{B2}, {GRAPH}, {FRONT} SELECT * FROM fr",
    "density_gaps": f"{B2}, {GRAPH}, {FRONT}, {DENSITY} SELECT keyword, round(density, 6) AS density, round(proximity, 6) AS proximity FROM dg",
    "bridge_gaps": f"{B2}, {GRAPH}, {FRONT}, {PAIRS}, {BRIDGE} SELECT f1, f2, shared, round(ratio, 6) AS ratio, round(potential, 6) AS potential FROM br",
    "semantic_gaps": f"{B4}, {GRAPH}, {FRONT}, {PAIRS}, st0 AS (SELECT DISTINCT node FROM fk), {HOPS.format(n=4)}, ds AS (SELECT x.community AS f1, y.community AS f2, min(hops) AS distance FROM hp JOIN fk x ON source = x.node JOIN fk y ON hp.node = y.node WHERE x.community < y.community AND hops > 0 GROUP BY 1, 2) SELECT f1, f2, CAST(distance AS INTEGER) AS distance, least(0.85, round((s1 + s2) / 2 / greatest(1, distance), 3)) AS score FROM fp ANTI JOIN dr USING (f1, f2) JOIN ds USING (f1, f2) ORDER BY score DESC, f1, f2 LIMIT 10",
    "broker_gaps": f"{B2}, {GRAPH}, {FRONT}, {BROKERS} SELECT * FROM bk",
    "gaps_ranked": f"{B2}, {GRAPH}, {FRONT}, {PAIRS}, {DENSITY}, {BRIDGE}, {TEMPORAL}, {RANKED} SELECT CAST(row_number() OVER (ORDER BY gap_score DESC, gap_type, label) AS INTEGER) AS rank, gap_type, label, gap_score, CASE WHEN gap_score > CASE WHEN gap_type = 'temporal' THEN 0.5 ELSE 0.6 END THEN 'high' ELSE 'medium' END AS opportunity FROM rs ORDER BY gap_score DESC, gap_type, label LIMIT 20",
    "vis_edges": f"{B2} SELECT keyword_a AS source, keyword_b AS target, round(weight / (SELECT max(weight) FROM edges) * 5, 2) AS value FROM edges",
    "vis_nodes": f"{B2}, {GRAPH} SELECT node AS id, round(greatest(5, least(40, 5 + 8 * ln(f + 1))), 1) AS value, split_part(node, ' ', 1) AS \"group\" FROM (SELECT node, sum(weight) AS f FROM both_ways GROUP BY 1)",
    "trend_chart": f"{B2}, {GRAPH}, {FRONT} SELECT g.keyword, CAST(sum(n) AS BIGINT) AS total, string_agg(CAST(n AS VARCHAR), ',' ORDER BY g.year) AS series FROM (SELECT k.keyword, a.year, coalesce(n, 0) AS n FROM (SELECT DISTINCT node AS keyword FROM fk) k CROSS JOIN axis a LEFT JOIN yearly y ON y.keyword = k.keyword AND y.year = a.year) g GROUP BY 1",
    "year_filter": f"WITH {OCC}, r AS (SELECT l_orderkey AS p, count(*) AS c FROM lineitem GROUP BY 1) SELECT o_orderkey AS paper_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(coalesce(c, 0) AS INTEGER) AS n_keywords FROM orders LEFT JOIN r ON p = o_orderkey WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
    "incremental_union": "SELECT CAST(2015 + (doc_id * 7) % 11 AS INTEGER) AS year, count(*) AS n, count(lang) FILTER (2015 + (doc_id * 7) % 11 >= 2020) AS n_lang FROM documents GROUP BY 1",
    "citation_expand": "WITH e AS (SELECT l_orderkey AS x, l_partkey AS y FROM lineitem UNION SELECT l_partkey, l_orderkey FROM lineitem) SELECT DISTINCT y AS paper_id FROM e WHERE x IN (SELECT s_suppkey FROM supplier) AND y NOT IN (SELECT s_suppkey FROM supplier)",
    "labelled_quality": "SELECT lang, quality, count(*) AS n, CAST(sum(toxic) AS BIGINT) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2",
}
