"""Connected components of an edge table, by alternating star contractions (no edge list leaves the executors)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.store import compact, settle

ROWS = 100_000
"""Edges per partition: a small graph is worked on in few partitions."""


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node that it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).coalesce(parts).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    """Each node sends its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    ends = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(least.select(F.col("m").alias("a"), "b"))
    return ends.filter("a < b").coalesce(parts).distinct().coalesce(parts)


def components(links: DataFrame) -> DataFrame:
    """(a, b) pairs -> (node, component): the smallest node reachable, for every node of a link."""
    edges = compact(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), ROWS)
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark, parts = now, max(1, -(-now[0] // ROWS))
        edges = settle(_small_star(_large_star(edges, parts), parts))
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")))
    return compact(nodes.distinct(), ROWS)
