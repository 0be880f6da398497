"""Incremental corpora: new files appended batch by batch, and windowed counts of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAPER


def append_papers(spark: SparkSession, inbox: str, corpus: str, checkpoint: str):
    """A query that appends JSON lines arriving in inbox to the Parquet corpus and then stops; each file once, also after a crash."""
    new = spark.readStream.schema(PAPER).json(inbox)
    return new.writeStream.format("parquet").option("path", corpus).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rerun(spark: SparkSession, inbox: str, pipeline, checkpoint: str, **how):
    """A query that appends what has arrived in inbox to a pipeline's raw corpus, runs phases 2 to 6 again if there was anything, and
    stops. A batch that is seen again after a crash is left out by its number."""

    def batch(new: DataFrame, number: int) -> None:
        raw = pipeline.path("raw_corpus")
        mark = F.lit(f"batch-{number}")
        known = spark.read.parquet(raw)
        if known.filter(F.col("file") == mark).limit(1).count() or not new.limit(1).count():
            return
        start = (known.agg(F.max("ingest_seq")).first()[0] or 0) + 1
        new.withColumn("file", mark).withColumn("ingest_seq", F.monotonically_increasing_id() + start).write.parquet(raw, mode="append")
        pipeline.run(start=2, **how)

    new = spark.readStream.schema(PAPER).json(inbox)
    return new.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by window and key; works on streams (state bounded by the watermark) and on tables."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")
