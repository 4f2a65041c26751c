"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline.llm import common


def _towards_least(edges: DataFrame, whole: bool) -> DataFrame:
    """Join every node's neighbours to the least of them.

    ``whole``: all larger neighbours move (large star); else a node and its
    smaller neighbours move (small star). Edges are (a, b) with a > b.
    """
    if whole:
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ends = edges
    least = ends.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = ends.join(least, "a")
    if whole:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node.

    Alternates large-star and small-star steps, each written as a table, until
    every node points at a root. Steps combine before the shuffle, and joins
    against one row per node leave large nodes to Spark's skew handling.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct()
    now = common.written(spark, now, "edges")
    while True:
        now = common.written(spark, _towards_least(now, whole=True), "edges")
        now = common.written(spark, _towards_least(now, whole=False), "edges")
        several = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        inner = now.select("b").distinct().join(now.select(F.col("a").alias("b")), "b", "left_semi")
        if several.isEmpty() and inner.isEmpty():
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
