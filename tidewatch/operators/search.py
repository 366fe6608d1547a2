"""Content search with a cap per platform and time window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.operators.keywords import match_columns, term_columns

WINDOW_DAYS = 3
# Windows of a search, for each of a few platforms, up to which their cut-offs go to every task.
BROADCAST_WINDOWS = 10_000
# What parts the words of a post.
EDGE = r"[^\p{L}\p{N}_]"


def matches(content: Column, term: DataFrame | list[str] | None) -> Column:
    """Posts that hold any of the words, whole and in any case; no words selects all.

    ``term`` is a word list or the one-row result of ``search_term``, which stays part of
    the plan as a scalar subquery. Words of letters and digits are looked up among the
    post's own; only others need a pattern, and only where there are such words.
    """
    if isinstance(term, DataFrame):
        pattern, plain, odd = (term.select(c).scalar() for c in ("pattern", "plain", "odd"))
    else:
        words = F.array(*map(F.lit, term or [])).cast("array<string>")
        pattern, (plain, odd) = term_columns(words)[1], match_columns(words)
    own = F.split(F.lower(content), rf"{EDGE}+")
    return pattern.isNull() | F.arrays_overlap(own, plain) | (odd.isNotNull() & F.rlike(content, odd))


def capped(df: DataFrame, groups: list[str], order: list[Column], limit: int, unique: str,
           fan: int = 64, levels: int = 2, places: str | None = None) -> DataFrame:
    """The first ``limit`` rows of every group, exactly, without gathering a group in one task.

    Rows are ranked inside ``fan ** levels`` random slices of a group, survivors inside
    ``fan`` times fewer, down to the group itself, so the last task of a group sees at most
    ``fan * limit`` rows. A row among the first ``limit`` of its group is among the first
    ``limit`` of any slice, so how rows fall into slices never changes the result. The
    slice mixes in the partition number to spread copies of one row as well. ``places`` names a
    column that keeps each row's place in its group.
    """
    slices = fan ** levels
    df = df.withColumn("_slice", F.pmod(F.xxhash64(unique, F.spark_partition_id()), F.lit(slices)))
    for level in range(levels, -1, -1):
        df = df.withColumn("_slice", F.pmod(F.col("_slice"), F.lit(fan ** level)))
        ranked = Window.partitionBy(*groups, "_slice").orderBy(*order)
        df = df.withColumn("_place", F.row_number().over(ranked)).where(F.col("_place") <= limit)
    return df.drop("_slice").withColumnRenamed("_place", places) if places else df.drop("_slice", "_place")


def cut_offs(found: DataFrame, groups: list[str], limit: int) -> DataFrame:
    """The second in which each group reaches ``limit`` rows, as ``_cut``, and how many it may still take of it.

    Rows are counted per second first, so the running sum goes over these counts alone. Groups below the limit have none.
    """
    seconds = found.groupBy(*groups, F.unix_timestamp("created_at").alias("_second")).agg(F.count(F.lit(1)).alias("_rows"))
    so_far = Window.partitionBy(*groups).orderBy("_second").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        seconds.withColumn("_total", F.sum("_rows").over(so_far))
        .where((F.col("_total") >= limit) & (F.col("_total") - F.col("_rows") < limit))
        .select(*(F.col(g).alias(f"_{g}") for g in groups), F.col("_second").alias("_cut"),
                (F.lit(limit) - F.col("_total") + F.col("_rows")).alias("_open"))
    )


def first_posts(found: DataFrame, groups: list[str], limit: int, *, bounded_groups: bool = False) -> DataFrame:
    """The first ``limit`` posts of every group by time, then by id; exact, and without moving the others.

    Posts before the cut-off second pass, those after it go. Only those within it are ranked, by ``capped``, since
    any number of posts may share a second. ``bounded_groups`` says that the groups are few enough for their cut-offs,
    a row each, to be sent to every task.
    """
    cuts = cut_offs(found, groups, limit)
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    marked = found.withColumn("_at", F.unix_timestamp("created_at")).join(F.broadcast(cuts) if bounded_groups else cuts, same, "left")
    early = marked.where(F.col("_cut").isNull() | (F.col("_at") < F.col("_cut")))
    tied = capped(marked.where(F.col("_at") == F.col("_cut")), groups, [F.asc("created_at"), F.asc("post_id")], limit, "post_id",
                  places="_rank").where(F.col("_rank") <= F.col("_open")).drop("_rank")
    return early.unionByName(tied).select(*found.columns)


def search_posts(posts: DataFrame, term: DataFrame | list[str] | None, since: dates.Moment,
                 until: dates.Moment, *, limit: int | None = None, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Posts of [since, until) that match; with a ``limit``, at most so many per platform and window.

    Windows are ``window_days`` long from ``since``; earlier posts, then lower ids, go
    first. ``window_start`` tells the window of each post.
    """
    start, end = dates.as_utc(since), dates.as_utc(until)
    step = window_days * 86400
    elapsed = F.unix_timestamp("created_at") - F.lit(int(start.replace(tzinfo=dt.timezone.utc).timestamp()))
    window_start = dates.timestamp_literal(start) + F.make_dt_interval(
        days=F.floor(elapsed / step).cast("int") * window_days
    )
    found = posts.where(
        (F.col("created_at") >= dates.timestamp_literal(start))
        & (F.col("created_at") < dates.timestamp_literal(end))
        & matches(F.col("content"), term)
    ).withColumn("window_start", window_start)
    if limit is None:
        return found
    windows = (end - start) / dt.timedelta(days=window_days)
    return first_posts(found, ["Platform", "window_start"], limit, bounded_groups=windows <= BROADCAST_WINDOWS)
