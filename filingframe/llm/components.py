"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingframe.session import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: each node's neighbours move to its least neighbour.

    The large star moves the neighbours above the node, the small star the others
    and the node itself. Node and least neighbour meet by key, so no neighbour
    list is ever built; the minimum is reduced before it is shuffled.
    """
    if large:
        ends = edges.union(edges.select("b", "a"))
    else:
        ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ends.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = ends.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = ends.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a != b").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; ``root`` is the least node of its component.

    ``edges`` has two long columns. Loops are ignored, null ends are dropped, and
    no edges give no rows. Each round is written to the shared folder and the one before dropped.
    """
    a, b = edges.columns
    current = materialise(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().filter("a != b").distinct(), "edges"
    )
    state = None
    while True:
        current = materialise(_stars(_stars(current, large=True), large=False), "edges", replaces=current)
        seen = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == state or not seen[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = seen
