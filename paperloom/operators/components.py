"""Connected components by contraction, without any edge on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialize


def _compress(parent: DataFrame) -> DataFrame:
    """(node, root): follows parents to their ends, the steps doubling each time."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        longer = materialize(parent.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "jump")
        moved = longer.filter("moved").limit(1).count()
        discard(parent)
        parent = longer.select("node", "root")
        parent._paperloom_path = longer._paperloom_path
        if not moved:
            return parent


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the undirected edges; root is the least node of its component.

    Each round every node points to its least neighbour, chains are followed to their ends, and the
    edges between roots, which are far fewer, go into the next round. Every round is a written table.
    Null ends and loops are ignored; parallel edges count once; no edges give no rows.
    """
    left = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b")).distinct(), "edges")
    roots: DataFrame | None = None
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root"))
        parent = _compress(materialize(parent, "parent"))
        p = lambda end: parent.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
        fewer = materialize(left.join(p("a"), "a").join(p("b"), "b").filter(F.col("ra") != F.col("rb")).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        discard(left)
        left = fewer
        if roots is None:
            roots = parent
        else:
            # the least node of a component ends up as its root, as roots of a round are its least nodes
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            longer = materialize(roots.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
            discard(roots)
            discard(parent)
            roots = longer
    if roots is None:
        roots = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
