"""Verdicts on a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quality_report(n_papers, year_span, n_keywords, abstract_pct, dedup_pct, dominance):
    """(warnings, verdict) as columns, from columns of one summary row: none good, one or two fair, more poor."""
    checks = [
        (n_papers < 30, "few papers"), (year_span < 5, "short span"), (n_keywords < 50, "few keywords"),
        (abstract_pct < 50, "few abstracts"), (dedup_pct > 30, "many duplicates"), (dominance > 0.8, "one source dominates"),
    ]
    warnings = F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in checks]), lambda x: x.isNotNull())
    return warnings, F.when(F.size(warnings) == 0, "good").when(F.size(warnings) <= 2, "fair").otherwise("poor")


def summary(corpus: DataFrame, source_col: str = "journal") -> DataFrame:
    """One row: n_papers, year_span, n_keywords, n_keyword_uses, abstract_pct, source_share. A corpus without abstracts has 0 %."""
    long = F.count_if(F.length("abstract") > 50) if "abstract" in corpus.columns else F.lit(0)
    uses = F.coalesce(F.sum(F.size(F.coalesce("keywords", F.array().cast("array<string>")))), F.lit(0))
    base = corpus.agg(F.count("*").alias("n_papers"), F.coalesce(F.max("year") - F.min("year") + 1, F.lit(0)).alias("year_span"), (100.0 * long / F.greatest(F.lit(1), F.count("*"))).alias("abstract_pct"), uses.alias("n_keyword_uses"))
    kws = corpus.select(F.explode("keywords").alias("k")).agg(F.countDistinct("k").alias("n_keywords"))
    per = corpus.groupBy(source_col).agg(F.count("*").alias("n"))
    share = per.agg(F.coalesce(F.max("n") / F.sum("n"), F.lit(0.0)).alias("source_share"))
    return base.join(kws).join(share).select("n_papers", "year_span", "n_keywords", "n_keyword_uses", "abstract_pct", "source_share")


def assess(corpus: DataFrame, source_col: str = "journal", n_removed: int = 0) -> DataFrame:
    """One row: n_papers, year_span, n_keywords, abstract_pct, dedup_pct, source_share, warnings, verdict. n_removed: duplicates that
    went before the corpus was what it is."""
    row = summary(corpus, source_col).withColumn("dedup_pct", 100.0 * F.lit(n_removed) / F.greatest(F.lit(1), F.col("n_papers") + n_removed))
    warnings, verdict = quality_report(F.col("n_papers"), F.col("year_span"), F.col("n_keywords"), F.col("abstract_pct"), F.col("dedup_pct"), F.col("source_share"))
    return row.select("n_papers", "year_span", "n_keywords", F.round("abstract_pct", 1).alias("abstract_pct"), F.round("dedup_pct", 1).alias("dedup_pct"), F.round("source_share", 4).alias("source_share"), F.array_join(warnings, "; ").alias("warnings"), verdict.alias("verdict"))


def by_source(corpus: DataFrame, source_col: str = "source") -> DataFrame:
    return corpus.groupBy(F.coalesce(F.col(source_col), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


def confidence(n_papers: int, year_span: int, abstract_pct: float) -> str:
    failed = (n_papers < 50) + (year_span < 5) + (abstract_pct < 50)
    return "HIGH" if not failed else "MEDIUM" if failed <= 2 else "LOW"


def item_confidence(score: float, *, frontier: bool = False, inferred: bool = False) -> str:
    """Of one frontier or gap of a report."""
    if inferred:
        return "LOW (inferred)"
    return "HIGH" if score >= 0.5 else "MEDIUM" if frontier or score >= 0.3 else "LOW"
