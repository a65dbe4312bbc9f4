"""Connected components of an edge table by alternating large and small stars; everything stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import stash


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that both sides of the join come straight from a shuffle: then a hub's rows are split over tasks at run time.
    least = stash(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (id, component) for every id that has a link to another; component is the smallest id reachable.
    Self-links, repeated links, nulls and an empty table are fine. A hub's neighbours are never gathered in one row: both
    stars are a minimum, which is combined before its shuffle, and a join, which adaptive execution splits if it is skewed."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before, edges = None, stash(edges, "edges")
    while True:
        edges = stash(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == now or not now[0]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        before = now
