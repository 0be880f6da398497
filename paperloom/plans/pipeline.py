"""One run over a corpus: ingest, clean, analyze, frontiers, gaps, report.

Every phase reads what the ones before wrote and writes its own tables and files under one folder, so a run can begin and end at any
phase. A phase whose inputs and settings are the same as last time (a manifest beside its results says so) may be skipped.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import logging
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config, adaptive
from ..functions import lexicon
from ..functions.text import year_between, years_of
from ..operators import biblio, dedup, frontier, gaps, graph, keywords, quality, report
from ..operators.store import scratch
from ..sources import readers, sinks

log = logging.getLogger("paperloom")
PHASES = ("ingest", "clean", "analyze", "frontiers", "gaps", "report")
#: What each phase leaves behind, by which a later run can tell that it is there.
OUTPUTS = {"ingest": "raw_corpus", "clean": "corpus", "analyze": "cooccurrence", "frontiers": "frontiers.json", "gaps": "gaps.json", "report": "report/summary.txt"}


def clean(papers: DataFrame, cfg: Config = DEFAULT, *, years: str | None = None, synonyms: dict[str, list[str]] | None = None, method: str = "tfidf", noise: list[str] | None = None, lookup: DataFrame | None = None, vectors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(corpus, removed): valid rows within the years, without duplicates, filled from look-ups, with keywords_normalized.

    lookup: papers by DOI that fill what is missing. vectors: (id, embedding) of the papers, for a second pass of deduplication.
    method: how keywords are found in abstracts (tfidf, words, embedding, none).
    """
    p = readers.valid(papers).filter(year_between(F.col("year"), years_of(years)))
    p, removed = dedup.deduplicate(p, cfg.title_similarity, compat=cfg.compat)
    if vectors is not None:
        near = dedup.embedding_dedup(vectors.join(p.select("id"), "id", "left_semi"), cfg.embedding_similarity, "id", "embedding")
        removed = removed.unionByName(near.select(F.lit("embedding_sim").alias("reason"), F.col("removed").alias("removed_id"), F.col("kept").alias("kept_id"), F.lit(None).cast("double").alias("sim")))
        p = p.join(near.select(F.col("removed").alias("id")), "id", "left_anti")
    if lookup is not None:
        p = dedup.enrich(p, lookup)
    return keywords.with_keywords(p, method=method, synonyms=lexicon.synonym_map(synonyms), noise=noise, distinct=not cfg.compat), removed


def corpus_view(papers: DataFrame) -> DataFrame:
    """A cleaned corpus as the analysis reads it."""
    return papers.withColumn("paper_id", F.col("id")).withColumn("keywords", F.col("keywords_normalized"))


class Timeout(RuntimeError):
    pass


class Pipeline:
    """Runs over one output folder. fetch: see sources.readers; only look-ups and searches need it."""

    def __init__(self, spark: SparkSession, out: str, cfg: Config = DEFAULT, *, fetch: readers.Fetch | None = None, phase_seconds: float | None = None, cache: bool = False):
        self.spark, self.out, self.cfg, self.fetch, self.phase_seconds, self.cache = spark, out.rstrip("/"), cfg, fetch, phase_seconds, cache

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name), mode="overwrite")
        return self.table(name)

    def document(self, name: str):
        return json.loads(sinks.read_text(self.spark, self.path(name)) or "null")

    def run(self, mode: str | None = None, path: str | None = None, *, start: int = 1, stop: int = 6, years: str | None = None, query: str | None = None, **how) -> dict:
        """The phases from `start` to `stop` (1 to 6). mode and path, or a query, say what phase 1 reads. Returns the run's statistics."""
        steps: dict[str, Callable[[], None]] = {
            "ingest": lambda: self._ingest(mode, path, query, years, how), "clean": lambda: self._clean(years, how), "analyze": self._analyze,
            "frontiers": self._frontiers, "gaps": self._gaps, "report": self._report,
        }
        if not 1 <= start <= stop <= len(PHASES):
            raise ValueError("phases go from 1 to 6")
        for name in PHASES[: start - 1]:
            if not sinks.exists(self.spark, self.path(OUTPUTS[name])):
                raise FileNotFoundError(f"phase {name} has left nothing to resume from")
        settings = {"mode": mode, "path": path, "query": query, "years": years, **{k: str(v) for k, v in how.items()}, **dataclasses.asdict(self.cfg)}
        for name in PHASES[start - 1 : stop]:
            key = hashlib.sha256(json.dumps([name, settings, self._input_key(name, path)], default=str).encode()).hexdigest() if self.cache else None
            if key and sinks.read_text(self.spark, self.path(f"{name}.key")) == key and sinks.exists(self.spark, self.path(OUTPUTS[name])):
                log.info("%s: as before", name)
                continue
            began = time.time()
            with scratch(self.spark):
                self._timed(name, steps[name])
            log.info("%s: %.1f s", name, time.time() - began)
            if not sinks.exists(self.spark, self.path(OUTPUTS[name]), 0):
                raise RuntimeError(f"phase {name} has left nothing behind")
            if key:
                sinks.write_text(self.spark, self.path(f"{name}.key"), key)
        return self.document("stats_summary.json") or {}

    def _input_key(self, name: str, path: str | None) -> str:
        """Of what a phase reads: the hash of its files, or the key of the phase before."""
        if name == "ingest":
            return sinks.digest(self.spark, path) if path else ""
        return sinks.read_text(self.spark, self.path(f"{PHASES[PHASES.index(name) - 1]}.key")) or ""

    def _changed(self) -> None:
        """What phase 1 left is no more what it was."""
        sinks.write_text(self.spark, self.path("ingest.key"), uuid.uuid4().hex)

    def _timed(self, name: str, step: Callable[[], None]) -> None:
        """step as one group of jobs, which is cancelled after phase_seconds."""
        sc = self.spark.sparkContext
        group, late = f"paperloom-{name}-{uuid.uuid4().hex}", threading.Event()

        def stop() -> None:
            late.set()
            sc._jsc.sc().cancelJobGroupAndFutureJobs(group)

        timer = threading.Timer(self.phase_seconds, stop) if self.phase_seconds else None
        sc.setJobGroup(group, f"phase {name}", interruptOnCancel=True)
        try:
            if timer:
                timer.start()
            step()
        except Exception as e:
            if late.is_set():
                raise Timeout(f"phase {name} took over {self.phase_seconds} s") from e
            raise
        else:
            if late.is_set():
                raise Timeout(f"phase {name} took over {self.phase_seconds} s")
        finally:
            if timer:
                timer.cancel()
            sc.setLocalProperty("spark.jobGroup.id", None)

    def _ingest(self, mode: str | None, path: str | None, query: str | None, years: str | None, how: dict) -> None:
        more = {k: how[k] for k in ("max_results", "lang") if k in how}
        if mode == "search":
            more["years"] = years_of(years)
        found = readers.read(self.spark, mode, path, query=query, fetch=self.fetch, **(more if mode == "search" else {}))
        self.put(found.withColumn("ingest_seq", F.coalesce("ingest_seq", F.monotonically_increasing_id())), "raw_corpus")
        sinks.write_raw(self.table("raw_corpus"), self.path("raw_corpus.jsonl"))

    def _clean(self, years: str | None, how: dict) -> None:
        raw = self.table("raw_corpus")
        lookup = how.get("lookup")
        if lookup is None and self.fetch is not None:
            lookup = readers.lookup(raw, readers.retried(self.fetch))
        corpus, removed = clean(raw, self.cfg, years=years, lookup=lookup, **{k: how[k] for k in ("synonyms", "method", "noise", "vectors") if k in how})
        corpus, removed = self.put(corpus, "corpus"), self.put(removed, "removed")
        sinks.write_clean(corpus, self.path("clean_corpus.csv"))
        view = corpus_view(corpus)
        stats = biblio.corpus_summary(view).first().asDict() | biblio.citation_stats(view).first().asDict()
        stats |= dedup.removal_counts(removed).first().asDict() | {"failed_extractions": raw.count() - readers.valid(raw).count()}
        stats["year_range"] = [stats.pop("year_min"), stats.pop("year_max")]
        stats["top_keywords_50"] = biblio.top_list(biblio.keyword_freq(view, not self.cfg.compat), "keyword", "total_count", 50)
        stats["top_journals_10"] = biblio.top_list(biblio.top_values(view, "journal", 10), "journal", "n", 10)
        sinks.write_text(self.spark, self.path("stats_summary.json"), sinks.to_json(stats))

    def _analyze(self) -> None:
        view, distinct = corpus_view(self.table("corpus")), not self.cfg.compat
        counts = self.put(biblio.keyword_years(view, distinct), "keyword_years")
        trends = self.put(biblio.trends_of(counts, rising_over=self.cfg.rising_over, declining_under=self.cfg.declining_under), "trends")
        edges = self.put(biblio.cooccurrence(view, self.cfg.top_k, self.cfg.min_weight, distinct, biblio.freq_of(counts)), "cooccurrence")
        authors = self.put(biblio.author_network(view, self.cfg.min_weight), "author_network")
        sinks.write_csv(biblio.keyword_table(counts, trends), self.path("keyword_freq.csv"))
        sinks.write_csv(edges.orderBy(F.desc("weight"), "keyword_a", "keyword_b"), self.path("cooccurrence.csv"))
        sinks.write_csv(authors.orderBy(F.desc("weight"), "author_a", "author_b"), self.path("author_network.csv"))
        top = biblio.top_trends(trends, self.cfg.trend_keywords)
        years = [r.year for r in biblio.years_of(counts).orderBy("year").collect()]
        sinks.write_text(self.spark, self.path("trends.json"), sinks.to_json(sinks.trend_document(top, biblio.yearly_of(counts), years)))
        listed = lambda label: sinks.rows(biblio.top_trends(trends.filter(F.col("trend") == label) if label else trends, 20))
        more = {"unique_keywords": trends.count(), "cooccurrence_pairs": edges.count(), "author_collab_pairs": authors.count(), "top_keywords_20": listed(None), "rising_keywords": listed("rising"), "declining_keywords": listed("declining")}
        sinks.merge_stats(self.spark, self.path("stats_summary.json"), more)

    def _frontiers(self) -> None:
        cfg, counts, edges, trends = self.cfg, self.table("keyword_years"), self.table("cooccurrence"), self.table("trends")
        years, yearly, freq = biblio.years_of(counts), biblio.yearly_of(counts), biblio.freq_of(counts)
        view = corpus_view(self.table("corpus"))
        limits = adaptive(quality.summary(view)).first()
        top = biblio.top_trends(trends, cfg.trend_keywords)
        bursts = self.put(biblio.bursts(yearly.join(graph.small(top.select("keyword")), "keyword", "left_semi"), years, limits.gamma if cfg.adaptive else cfg.burst_gamma), "bursts")
        pruned = graph.prune(edges, cfg.trend_keywords)
        partition = self.put(graph.communities(pruned, cfg.resolution), "partition")
        span = years.agg(F.min("year").alias("year_min"), F.max("year").alias("year_max"))
        # a twentieth of the keywords of the graph, which are fewer than those of the corpus
        nodes = partition.count()
        least = limits.cluster_size_by_papers if cfg.compat else min(limits.cluster_size, max(2, int(0.05 * nodes)))
        found = self.put(frontier.frontiers(pruned, partition, top, yearly, bursts, span, min_cluster=least, cfg=cfg), "frontiers")
        shape = graph.density(pruned).first()
        out = {
            "frontiers": sinks.rows(found.orderBy(F.desc("frontier_score"), "community")), "burst_keywords": sinks.rows(frontier.burst_list(bursts, freq, trends)), "active_bursts": frontier.active_bursts(bursts, years),
            "topology": shape.asDict() | {"n_communities": partition.select("community").distinct().count(), "modularity": round(graph.modularity(pruned, partition), 4)},
            "parameters": {"burst_gamma": limits.gamma if cfg.adaptive else cfg.burst_gamma, "top_n_keywords": cfg.trend_keywords, "min_cluster_size": least}, "thresholds": limits.asDict(),
        }
        sinks.write_text(self.spark, self.path("frontiers.json"), sinks.to_json(out))

    def _gaps(self) -> None:
        cfg, counts, edges, trends = self.cfg, self.table("keyword_years"), self.table("cooccurrence"), self.table("trends")
        fk = self.put(gaps.frontier_keywords(self.table("frontiers")), "frontier_keywords")
        yearly, years, freq, n = biblio.yearly_of(counts), biblio.years_of(counts), biblio.freq_of(counts), biblio.papers_of(counts)
        proximity = cfg.proximity_over
        if cfg.adaptive:
            proximity = adaptive(quality.summary(corpus_view(self.table("corpus")))).first().proximity
        density = self.put(gaps.density_gaps(edges, fk, freq, n, proximity), "density_gaps")
        bridge = self.put(gaps.bridge_gaps(edges, fk), "bridge_gaps")
        temporal = self.put(biblio.temporal_decline(yearly, years, n, floor=cfg.temporal_floor, share=cfg.temporal_share, decline=cfg.temporal_decline), "temporal_gaps")
        semantic = self.put(gaps.semantic_gaps(edges, fk, by_weight=cfg.compat), "semantic_gaps")
        last = years.agg(F.max("year")).first()[0] or 0
        ranked = gaps.rank_gaps(density, bridge, temporal, trends, last, None if cfg.compat else semantic, cfg.gaps)
        ranked = self.put(gaps.ranked_or_inferred(ranked, edges, fk, cfg.gaps), "gaps")
        out = {
            "gaps": sinks.rows(ranked.orderBy("rank")), "gap_summary": {"density_gaps": density.count(), "bridge_gaps": bridge.count(), "temporal_gaps": temporal.count(), "semantic_gaps": semantic.count(), "by_type": {r.gap_type: r.n for r in gaps.gap_counts(ranked).collect()}, "top_n": ranked.count()},
            "parameters": {"density_threshold": proximity, "bridge_edge_ratio_max": 0.25, "temporal_years_needed": 6},
        }
        sinks.write_text(self.spark, self.path("gaps.json"), sinks.to_json(out))

    def _report(self) -> None:
        counts, edges, trends, found = self.table("keyword_years"), self.table("cooccurrence"), self.table("trends"), self.table("frontiers")
        fk, ranked, density, bridge = self.table("frontier_keywords"), self.table("gaps"), self.table("density_gaps"), self.table("bridge_gaps")
        corpus = self.table("corpus")
        view = corpus_view(corpus)
        years = [r.year for r in biblio.years_of(counts).orderBy("year").collect()]
        gap_keywords = ranked.filter(F.col("gap_type").isin("density", "temporal")).select(F.regexp_replace("label", "^Broker: ", "").alias("keyword"))
        nodes = report.marked_nodes(edges, found, gap_keywords)
        vis = {"nodes": sinks.rows(nodes.orderBy(F.desc("value"), "id")), "edges": sinks.rows(report.vis_edges(edges, self.cfg.min_weight).orderBy(F.desc("value"), "source", "target"), 50_000)}
        series = report.trend_chart(biblio.yearly_of(counts), report.highlights(found, gap_keywords, bridge), years, trends)
        chart = {"years": years, "series": [r | {"series": [int(x) for x in r["series"].split(",")] if r["series"] else []} for r in sinks.rows(series)]}
        own = density.select(F.col("keyword").alias("gap"), "keyword", F.col("nearby_frontier").alias("home"))
        # a bridge's shared neighbours are its keywords
        shared = bridge.select(F.concat_ws(" <-> ", "f1", "f2").alias("gap"), F.explode("shared_neighbors").alias("keyword"), F.lit(None).cast("string").alias("home"))
        chosen = (own if self.cfg.compat else own.unionByName(shared)).join(ranked.select(F.col("label").alias("gap"), "rank").filter("rank <= 10"), "gap").drop("rank")
        grid = report.frontier_gap_matrix(edges, fk, chosen, 10).groupBy("gap", "frontier").agg(F.max("relevance").alias("relevance"))
        stats = self.document("stats_summary.json") or {}
        verdict = quality.assess(view, "journal", stats.get("n_removed", 0)).first().asDict()
        best, worst = sinks.rows(found.orderBy(F.desc("frontier_score"), "community")), sinks.rows(ranked.orderBy("rank"))
        context = {
            "corpus_stats": {"n_papers": verdict["n_papers"], "year_range": [years[0], years[-1]] if years else [], "n_keywords": verdict["n_keywords"], "n_cooccurrence": edges.count(), "abstract_pct": verdict["abstract_pct"], "verdict": verdict["verdict"]},
            "frontiers": best, "gaps": worst, "network": vis, "trends": chart, "matrix": sinks.rows(grid.orderBy("gap", "frontier")), "papers": sinks.rows(report.paper_rows(corpus)),
            "top_keywords": stats.get("top_keywords_20", []), "rising_keywords": stats.get("rising_keywords", [])[:10], "declining_keywords": stats.get("declining_keywords", [])[:10], "quality": verdict,
        }
        files = {"vis_data.json": vis, "trend_data.json": chart, "frontier_heatmap.json": context["matrix"], "report_context.json": context}
        for name, value in files.items():
            sinks.write_text(self.spark, self.path(f"report/{name}"), sinks.to_json(value))
        sinks.write_text(self.spark, self.path("report/report.md"), report.markdown("Frontiers and gaps", found, ranked, 10, context["corpus_stats"]))
        sinks.write_text(self.spark, self.path("report/summary.txt"), report.summary_text(context))

    def check(self) -> dict:
        """The cleaned corpus's figures and verdict, without a run."""
        view = corpus_view(self.table("corpus"))
        row = quality.assess(view, "journal", (self.document("stats_summary.json") or {}).get("n_removed", 0)).first().asDict()
        return row | {"thresholds": adaptive(quality.summary(view)).first().asDict()}

    def append(self, mode: str, path: str, **how) -> dict:
        """More papers to the raw corpus, then phases 2 to 6 again."""
        more = readers.read(self.spark, mode, path, fetch=self.fetch)
        start = (self.table("raw_corpus").agg(F.max("ingest_seq")).first()[0] or 0) + 1
        more = more.withColumn("ingest_seq", F.monotonically_increasing_id() + start)
        with scratch(self.spark):
            more.write.parquet(self.path("raw_corpus"), mode="append")
        self._changed()
        return self.run(start=2, **how)

    def expand(self, found: DataFrame, limit: int = 50, **how) -> dict:
        """Papers of a citation chase, those that are new by id and DOI, at most `limit`; then phases 2 to 6 again. The seeds stay."""
        with scratch(self.spark):
            raw = self.table("raw_corpus")
            start = (raw.agg(F.max("ingest_seq")).first()[0] or 0) + 1
            new = dedup.new_papers(found, raw, limit)
            self.put(new.withColumn("ingest_seq", F.monotonically_increasing_id() + start), "expansion").write.parquet(self.path("raw_corpus"), mode="append")
        self._changed()
        return self.run(start=2, **how)
