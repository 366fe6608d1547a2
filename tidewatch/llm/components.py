"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.storage import stored


def _nearest(directed: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, the node itself included; combined before the shuffle."""
    return directed.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_nearest(both), "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = _nearest(down)
    rest = down.join(near, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(near.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of an edge (a, b) with a <> b; the component is its smallest id.

    Each round halves the depth at least; its edges go to the shared folder, so that lineage stays short and a lost
    executor costs one round. Nulls, loops and repeated edges are ignored.
    """
    now = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        now = stored(_small_star(_large_star(now)).filter("a <> b").distinct(), "edges", replaces=now)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
