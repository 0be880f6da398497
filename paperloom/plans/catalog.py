"""What a run has written, and the functions that SQL lacks, under names of the session's catalog."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.text import title_ratio
from ..operators.ship import ship
from ..sources import sinks
from .pipeline import Pipeline

#: Tables that the phases of a run leave behind.
TABLES = ("raw_corpus", "corpus", "removed", "keyword_years", "trends", "cooccurrence", "author_network", "bursts", "partition", "frontiers", "density_gaps", "bridge_gaps", "temporal_gaps", "semantic_gaps", "gaps")


def register_views(pipeline: Pipeline, prefix: str = "") -> list[str]:
    """A temporary view for each table that is there; their names."""
    found = [t for t in TABLES if sinks.exists(pipeline.spark, pipeline.path(t), 0)]
    for t in found:
        pipeline.table(t).createOrReplaceTempView(prefix + t)
    return [prefix + t for t in found]


def register_functions(spark: SparkSession) -> None:
    """title_ratio(later, earlier), the similarity of two titles."""
    ship(spark)

    @F.pandas_udf("double")
    def ratio(later: pd.Series, earlier: pd.Series) -> pd.Series:
        return pd.Series([title_ratio(a, b) for a, b in zip(later, earlier, strict=True)], dtype="float64")

    spark.udf.register("title_ratio", ratio)
