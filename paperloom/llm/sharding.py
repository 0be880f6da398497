"""Sharding by a two-pass external shuffle, under the law ``rows``.

Pass one scatters the records: each gets a seeded 64-bit hash of its id, its text and its number among equal
records, so copies and repeated ids spread like any other rows, and is written to the shared folder with that
hash. The number of buckets follows from the bytes written, so that a bucket fits into a worker's memory. Pass
two deals the records out by bucket, orders each bucket by its hash, shuffles it in memory by Fisher-Yates with
a generator seeded by bucket, and numbers it from the bucket's start. The global position decides the shard:
shard s holds the positions from ceil(s*n/shards), so the counts of two shards differ by one at most and each
bucket reaches into few shards. The seed alone fixes the result, whatever files and partitions the records
come from.

A bucket's start is the sum of the counts before it, taken in two steps inside Spark: over blocks of ``BLOCK``
buckets, and inside each. The driver holds two numbers.

Defined cases: null text has no bytes (size 16, crc 0); null ids are ids like any other; an empty table gives
an empty result; with fewer rows than shards some shards are empty; repeated rows are placed one by one; very
long texts fill a bucket alone; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.store import materialize
from .common import numbered, row_key, small_batches, table, tidied

SHARDS = 40
SEED = 20_240_229
BUCKET_BYTES = 16 << 20
#: Buckets whose counts one task sums up.
BLOCK = 4_096
#: What a record costs besides its text.
RECORD_BYTES = 16


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    order = list(range(n))
    if n > 1:
        picks = rng.integers(0, np.arange(n, 1, -1))
        for i, j in zip(range(n - 1, 0, -1), picks.tolist(), strict=True):
            order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def shuffle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """id_col, text_col, size, text_crc32, law, shard, slot, grown_shard: one row per record."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    scattered = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        (F.octet_length(body) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        row_key(F.col(text_col)).alias("key"),
    )
    scattered = numbered(scattered, ["id", "key", "size", "crc"]).withColumn("u", F.xxhash64(F.lit(seed), "id", "key", "_copy")).drop("_copy")
    scattered = materialize(scattered, "scatter")
    total = scattered.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n, buckets = total.n, max(1, -(-(total.bytes or 0) // bucket_bytes))
    dealt = scattered.withColumn("bucket", F.pmod(F.col("u"), F.lit(buckets)))

    @tidied
    def deal(key, t):
        bucket = key[0].as_py()
        order = np.lexsort((t.column("key").to_numpy(), t.column("u").to_numpy()))
        order = order[fisher_yates(len(order), np.random.default_rng([seed, bucket]))]
        out = t.select(["id", "text", "size", "crc"]).take(pa.array(order))
        return out.append_column("pos", pa.array(t.column("start")[0].as_py() + np.arange(len(order)), pa.int64()))

    kind = dict(docs.dtypes)[id_col]
    counts = dealt.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("bucket") / BLOCK))
    counts = materialize(counts, "buckets")  # three numbers for each bucket_bytes of data
    blocks = counts.groupBy("block").agg(F.sum("n").alias("of_block"))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("block", before(Window.orderBy("block"), "of_block").alias("above"))  # one row for each 64 GB of data
    starts = counts.withColumn("inside", before(Window.partitionBy("block").orderBy("bucket"), "n")).join(F.broadcast(blocks), "block").select("bucket", (F.col("above") + F.col("inside")).alias("start"))
    out = small_batches(dealt.join(starts, "bucket")).groupBy("bucket").applyInArrow(deal, f"id {kind}, text string, size long, crc long, pos long")
    shard = F.expr(f"(pos * {shards}) div {max(1, n)}")
    first = F.expr(f"(CAST(shard AS BIGINT) * {n} + {shards - 1}) div {shards}")
    return out.withColumn("shard", shard.cast("int")).select(F.col("id").alias(id_col), F.col("text").alias(text_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", (F.col("pos") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write(shuffled: DataFrame, path: str) -> None:
    """One folder a shard; the files of a folder hold their records in slot order."""
    shuffled.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return shuffle(table(spark, sf_dir, "documents")).drop("text")
