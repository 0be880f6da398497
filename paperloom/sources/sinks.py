"""What a run leaves behind: tables as Parquet, the exported files beside them.

A whole table is written by the executors (a folder of part files); the small results of a run (a few hundred rows at most)
as one file each, through Hadoop's file system, so the target may be any store that Spark knows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import columns_of
from ..schemas import CLEAN

BOM = "﻿"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file, replaced if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text, None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0].value if rows else ""


def exists(spark: SparkSession, path: str, least: int = 10) -> bool:
    """Is there a file or folder of more than `least` bytes?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getContentSummary(p).getLength() > least


def write_raw(papers: DataFrame, path: str) -> None:
    """JSON lines, as readers.read_jsonl reads them."""
    papers.write.json(path, mode="overwrite")


def flat(df: DataFrame) -> DataFrame:
    """Arrays joined by '; '; maps left out."""
    return df.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes if not t.startswith("map")])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every part; a field that holds quotes or line ends is quoted."""
    flat(df).write.csv(path, header=True, mode="overwrite", escape='"', quoteAll=False)


def clean_columns(papers: DataFrame) -> DataFrame:
    """The thirteen columns of a cleaned corpus."""
    renamed = papers.withColumn("keywords_raw", F.col("keywords"))
    return renamed.select(*[F.col(c).cast(t).alias(c) for c, t in columns_of(CLEAN).items()])


def write_clean(papers: DataFrame, path: str) -> None:
    """The cleaned corpus as CSV; the header's first name begins with a byte order mark, which spreadsheets look for."""
    out = flat(clean_columns(papers))
    out.withColumnRenamed(out.columns[0], BOM + out.columns[0]).write.csv(path, header=True, mode="overwrite", escape='"')


def to_json(value) -> str:
    """JSON with infinities as 'Infinity', which Spark reads again."""
    return json.dumps(value, ensure_ascii=False, indent=2, default=str)


def rows(df: DataFrame, most: int = 10_000) -> list[dict]:
    """The rows of a small result as dictionaries; more than `most` are an error, not a cut."""
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"over {most} rows are no small result")
    return [r.asDict(recursive=True) for r in found]


def merge_stats(spark: SparkSession, path: str, more: dict) -> dict:
    """The statistics in a file with `more` on top, later keys winning; written again."""
    stats = json.loads(read_text(spark, path) or "{}") | more
    write_text(spark, path, to_json(stats))
    return stats


def trend_document(top: DataFrame, yearly: DataFrame, years: list[int]) -> dict:
    """{years, keywords: {keyword: {total, yearly, trend, cagr_3yr}}} of the top keywords."""
    series: dict = {}
    for r in yearly.join(F.broadcast(top.select("keyword")), "keyword", "left_semi").collect():
        series.setdefault(r.keyword, {})[str(r.year)] = r.n
    found = {r.keyword: {"total": r.total_count, "yearly": dict(sorted(series.get(r.keyword, {}).items())), "trend": r.trend, "cagr_3yr": r.cagr_3yr} for r in top.orderBy(F.desc("total_count"), "keyword").collect()}
    return {"years": years, "keywords": found}


def digest(spark: SparkSession, path: str) -> str:
    """The SHA-256 of what files hold, in the order of their names: the key under which a phase's results may be used again."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = files.select("path", F.sha2("content", 256).alias("h")).orderBy("path")
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "h"))), lambda x: x["h"]), ","), 256)).first()[0]


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)
