"""Reliable intermediate tables.

Long plans cut their lineage by writing a table into the folder that the cluster names in
``spark.checkpoint.dir``; every executor sees it, so the loss of an executor costs nothing.
A plain ``checkpoint()`` computes its input twice (once for the job, once for the file), a
written table once.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where the session names none and runs on this machine alone, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="paperloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes df once and returns a scan of what was written (same schema, empty tables too)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._paperloom_path = path
    for paths in getattr(spark.sparkContext, "_paperloom_scopes", []):
        paths.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes, at its end, the tables written inside; a path taken from the list stays. Results must be written or counted inside."""
    sc = spark.sparkContext
    scopes = sc._paperloom_scopes = getattr(sc, "_paperloom_scopes", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        yield paths
    finally:
        scopes[:] = [x for x in scopes if x is not paths]
        for path in paths:
            _delete(spark, path)


def discard(df: DataFrame) -> None:
    """Deletes a table written by materialize(), once nothing reads it any more."""
    path = getattr(df, "_paperloom_path", None)
    if path:
        _delete(df.sparkSession, path)
        df._paperloom_path = None


def release_heaps(spark: SparkSession) -> None:
    """Executors give heap that ended stages no longer use back to the system: a job of one small task for each core, each of
    which collects its executor's garbage. A heap that one stage has grown otherwise stays so beside the workers of the next."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).selectExpr("reflect('java.lang.System', 'gc') AS done").write.format("noop").mode("overwrite").save()
