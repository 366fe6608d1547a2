"""Idempotent views of the append-only raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """Greatest row per key, rows without a complete key untouched; one pass over the rows.

    A row without a complete key has a number of its own instead of the others' 0, so it is alone in its group. Each task
    keeps one row of a group before the shuffle: many copies of one row cost one row per task.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    rest = [c for c in df.columns if c not in prefer]
    alone = df.withColumn("_alone", F.when(whole, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1))
    greatest = Window.partitionBy(*keys, "_alone").orderBy(*(F.desc(c) for c in (*prefer, *rest) if c not in keys))
    return alone.withColumn("_place", F.row_number().over(greatest)).where("_place = 1").drop("_alone", "_place")


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per ``GlobalEventID``, the last processed."""
    return _one_per_key(events, ["GlobalEventID"], [c for c in ["ProcessedDate"] if c in events.columns])


def dedup_posts(posts: DataFrame) -> DataFrame:
    """One row per platform and post id, the last seen."""
    prefer = [c for c in ["lastseents", "ProcessedDate"] if c in posts.columns]
    return _one_per_key(posts, ["Platform", "post_id"], prefer)
