"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import inspect
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ship import ship
from ..operators.store import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A-Z to a-z and nothing else, on UTF-8 bytes.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

#: Arrow batches hand Python workers whole texts; a batch of very long ones stays this small.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the memory of the Python workers that read df, and lets them import this package."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(text: Column) -> Column:
    """Tells rows of one id but different texts apart; null has a key of its own."""
    return F.xxhash64(F.coalesce(text, F.lit("\u0000null")))


#: Rows known to repeat whose keys are broadcast (about 30 MB), and copies numbered by one row.
BROADCAST_KEYS, RUN = 500_000, 65_536


def numbered(df: DataFrame, by: list[str], name: str = "_copy") -> DataFrame:
    """df with a number that tells rows equal in `by` apart: 0 for a row without copies, else 0, 1, ...

    Rows equal in `by` must be equal altogether; they stand for each other, so the result is the same whatever files and
    partitions the rows come from. Only keys and counts are shuffled, and copies are made from one row of each kind, in runs.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("_n")).filter("_n > 1")
    counts = materialize(counts.select(*[F.col(c).alias(f"_{c}") for c in by], "_n"), "copies")
    if not counts.limit(1).count():
        return df.withColumn(name, F.lit(0).cast("long"))
    many = F.broadcast(counts) if counts.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else counts
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    single = df.join(many, same, "left_anti").withColumn(name, F.lit(0).cast("long"))
    one = df.join(many, same).dropDuplicates(by).select(*df.columns, "_n")
    runs = one.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(RUN).cast("long"))))
    runs = runs.repartition(F.xxhash64(*by, name))
    last = F.least(F.col(name) + RUN, F.col("_n")) - 1
    return single.unionByName(runs.withColumn(name, F.explode(F.sequence(F.col(name), last))).drop("_n"))


def _release() -> None:
    """Gives memory that a finished task no longer needs back to the system: workers are kept and used again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(f):
    """f, a function of Arrow batches or of a group, releasing memory when it ends."""
    if inspect.isgeneratorfunction(f):

        def run(batches):
            try:
                yield from f(batches)
            finally:
                _release()

    elif len(inspect.signature(f).parameters) == 1:

        def run(t):
            try:
                return f(t)
            finally:
                _release()

    else:

        def run(key, t):
            try:
                return f(key, t)
            finally:
                _release()

    return run
