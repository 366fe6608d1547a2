"""Aggregates over normalised posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import dates


# Authors, of a sum and an id each, that may be asked for and still be sent to every task.
BROADCAST_AUTHORS = 10_000


def _total(name: str) -> Column:
    """Sum that is 0, not null, when every value is missing."""
    return F.coalesce(F.sum(name), F.lit(0))


def daily_social_rollup(posts: DataFrame) -> DataFrame:
    """Every daily measure in one pass; posts without a time form a group of their own.

    The distinct count of authors makes Spark aggregate by (day, author) first and by day
    second, so a busy day is spread over its authors.
    """
    return posts.groupBy(F.to_date("created_at").alias("date")).agg(
        F.count(F.lit(1)).alias("posts"),
        _total("total_engagement").alias("engagement"),
        _total("likes_count").alias("likes"),
        _total("shares_count").alias("shares"),
        _total("comments_count").alias("comments"),
        _total("views_count").alias("views"),
        F.count_distinct("author_id").alias("uniqueAuthors"),
        (F.count_if("is_sponsored") / F.count(F.lit(1)) * 100).alias("sponsoredPercentage"),
    )


def metrics_of(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "date",
        F.struct("posts", "engagement", "likes", "shares", "comments", "views",
                 "uniqueAuthors", "sponsoredPercentage").alias("metrics"),
    ).orderBy("date")


def engagement_of(rollup: DataFrame) -> DataFrame:
    return rollup.select(F.col("date").alias("Date"), F.col("engagement").alias("total_engagement"))


def social_temporal_metrics(posts: DataFrame) -> DataFrame:
    """Posts, engagement, authors and sponsored share per day, as ``(date, metrics)``."""
    return metrics_of(daily_social_rollup(posts))


def social_daily_engagement(posts: DataFrame) -> DataFrame:
    """Engagement per day: the social side of the day-by-day pairing."""
    return posts.groupBy(F.to_date("created_at").alias("Date")).agg(
        _total("total_engagement").alias("total_engagement")
    )


def top_authors_engagement(posts: DataFrame, n: int = 10, *, by_platform: bool = False) -> DataFrame:
    """The ``n`` authors with most engagement, with the name and time of their first post.

    Ids are not told apart by platform unless ``by_platform``. The sums go first, over two
    narrow columns; the first posts are then looked up for the ``n`` winners alone, which
    is the most the broadcast side can hold.
    """
    keys = ["Platform", "author_id"] if by_platform else ["author_id"]
    top = (
        posts.groupBy(*keys).agg(_total("total_engagement").alias("engagement"))
        .orderBy(F.desc("engagement"), *(F.asc_nulls_last(k) for k in keys))
        .limit(n)
    )
    return first_posts_of(top, posts, by_platform=by_platform, few=n <= BROADCAST_AUTHORS)


def first_posts_of(top: DataFrame, posts: DataFrame, *, by_platform: bool = False, few: bool = True) -> DataFrame:
    """Name and time of the first of these posts of each author of ``top``, a few rows with their ``engagement``."""
    keys = ["Platform", "author_id"] if by_platform else ["author_id"]
    winners = top.select("engagement", *(F.col(k).alias(f"top_{k}") for k in keys))
    first = F.struct(
        F.col("created_at").isNull().alias("undated"), "created_at",
        *(["Platform"] if "Platform" in posts.columns else []), "post_id", "author_name",
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"top_{k}"))
    return (
        posts.join(F.broadcast(winners) if few else winners, same)
        .groupBy("engagement", *keys).agg(F.min(first).alias("first"))
        .orderBy(F.desc("engagement"), *(F.asc_nulls_last(k) for k in keys))
        .select(
            *(["Platform"] if by_platform else []),
            F.col("first.author_name").alias("author"), "engagement",
            F.col("first.created_at").alias("Date"),
        )
    )


def platform_engagement_distribution(posts: DataFrame, start: dates.Moment | None = None,
                                     end: dates.Moment | None = None) -> DataFrame:
    """Likes, shares and comments of each platform as percentages of their sum.

    The range is (start, end] and applies only with both bounds; a platform without any
    engagement gets nulls.
    """
    inside = dates.moment_in_open_range(F.col("created_at"), start, end)
    chosen = posts if inside is None else posts.where(inside)
    totals = chosen.groupBy("Platform").agg(
        _total("likes_count").alias("likes"),
        _total("shares_count").alias("shares"),
        _total("comments_count").alias("comments"),
    )
    whole = F.nullif(F.col("likes") + F.col("shares") + F.col("comments"), F.lit(0))
    return totals.select(
        F.col("Platform").alias("platform"),
        *((F.col(part) / whole * 100).alias(f"{part}_percentage") for part in ("likes", "shares", "comments")),
    ).orderBy("platform")
