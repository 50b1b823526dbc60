"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step. Every neighbour above a node is tied to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """One small-star step over edges with a > b: a node and its lower neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long), root being the least node of its component.

    Loops and repeated edges are allowed. A node's neighbours are only counted and joined, never gathered in one row.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current = stored(current, "edges")

    def sign(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(row)

    last = sign(current)
    while last[0]:
        current = stored(_small(_stars(current)), "edges")
        now = sign(current)
        if now == last:
            break
        last = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
