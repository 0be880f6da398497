"""Settings of the analysis and the thresholds that follow from a corpus's size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    top_k: int = 200
    min_weight: int = 2
    trend_keywords: int = 100
    rising_over: float = 1.3
    declining_under: float = 0.7
    burst_gamma: float = 1.0
    resolution: float = 1.5
    title_similarity: float = 0.85
    embedding_similarity: float = 0.95
    weight_burst: float = 0.35
    weight_recency: float = 0.30
    weight_growth: float = 0.25
    weight_cross: float = 0.10
    proximity_over: float = 0.5
    temporal_share: float = 0.05
    temporal_floor: int = 10
    temporal_decline: float = 0.3
    gaps: int = 20
    #: Take the thresholds that fit the corpus's size (see adaptive()) instead of the fixed ones.
    adaptive: bool = False
    #: Reproduce documented quirks of the batch scripts instead of their documented intent.
    compat: bool = False


DEFAULT = Config()


def adaptive(summary: DataFrame) -> DataFrame:
    """summary (one row: n_papers, n_keywords, year_span) with the thresholds that fit a corpus of that size.

    The least size of a cluster counts keywords, so a share of the papers is held against the same share of the keywords.
    """
    papers, keywords, years = F.col("n_papers"), F.col("n_keywords"), F.col("year_span")
    between = lambda x, low: F.greatest(F.lit(low), F.least(F.lit(1.0), x))
    full, span = between(papers / 100, 0.3), between(years / 10, 0.2)
    share = lambda n, part, least: F.greatest(F.lit(least), F.floor(part * n)).cast("int")
    return summary.select(
        "*",
        F.least(share(papers, 0.05, 2), share(keywords, 0.05, 2)).alias("cluster_size"), share(papers, 0.05, 2).alias("cluster_size_by_papers"),
        share(papers, 0.02, 1).alias("edge_weight"), (2 - span).alias("gamma"), F.greatest(F.lit(3), F.floor(F.round(6 * (1 - span), 9))).cast("int").alias("years_needed"),
        F.greatest(F.lit(0.2), full / 2).alias("proximity"), F.least(F.lit(0.5), 0.2 / full).alias("bridge_ratio"),
        (papers < 30).alias("is_small"), (years < 5).alias("is_short"), (keywords < 50).alias("is_sparse"), (keywords < 30).alias("is_very_sparse"),
    )
