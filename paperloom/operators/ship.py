"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's Python files, once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_paperloom_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="paperloom-src-"), "paperloom_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.join(os.path.basename(PACKAGE), os.path.relpath(full, PACKAGE)))
    sc.addPyFile(path)
    sc._paperloom_shipped = True
