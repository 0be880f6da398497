"""The test tables as corpora of papers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def basket_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a paper: its parts are keywords in line order, its suppliers authors, its priority the journal."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    part = read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.lower("p_brand")).alias("keyword"))
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    items = line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    items = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "keyword", "s_name"))).alias("x"))
    o = read(spark, sf_dir, "orders")
    o = o.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    pick = lambda c: F.coalesce(F.filter(F.transform("x", lambda i: i[c]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return o.select(F.col("o_orderkey").alias("paper_id"), F.year("o_orderdate").alias("year"), pick("keyword").alias("keywords"), pick("s_name").alias("authors"), F.col("o_orderpriority").alias("journal"), (F.col("o_totalprice") / 1000).cast("int").alias("citation_count"))


def text_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a paper: its first line is the title, its text the abstract."""
    d = read(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), F.col("source").alias("journal"), "lang", (2015 + F.pmod(F.col("doc_id") * 7, F.lit(11))).cast("int").alias("year"))
