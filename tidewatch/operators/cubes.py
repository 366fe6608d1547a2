"""Partial results by day that can be merged: what a refresh keeps, and what requests over a range of days read.

Each is a frame at the grain of a day and something within it, and has a function that merges any of its days into what
the operators compute from all events or posts. Sums and counts stay apart until then, so merging is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators import news, social

PLACE = ["ActionGeo_Lat", "ActionGeo_Long"]


def _mean(total: str, number: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(number))


def news_days(events: DataFrame) -> DataFrame:
    """Sums and counts of every daily measure by ``event_date``."""
    return events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("GoldsteinScale").alias("impact"), F.count("GoldsteinScale").alias("impacts"),
        F.sum("AvgTone").alias("tone"), F.count("AvgTone").alias("tones"),
        F.coalesce(F.sum("NumMentions"), F.lit(0)).alias("mentions"),
    )


def rollup_of(days: DataFrame) -> DataFrame:
    """``news.daily_news_rollup`` from its days."""
    return days.where(F.col("event_date").isNotNull()).groupBy(F.col("event_date").alias("Date")).agg(
        F.sum("events").alias("events"), _mean("impact", "impacts").alias("AvgImpact"),
        _mean("tone", "tones").alias("AvgTone"), F.sum("mentions").alias("mentions"))


def place_days(events: DataFrame) -> DataFrame:
    """Sums and counts by day and place, with the place's event of the lowest id on that day."""
    keys = ["event_date", *PLACE]
    counted = events.where(F.col(PLACE[0]).isNotNull() & F.col(PLACE[1]).isNotNull()).groupBy(*keys).agg(
        F.sum("GoldsteinScale").alias("impact"), F.count("GoldsteinScale").alias("impacts"),
        F.count(F.lit(1)).alias("events"), F.min("GlobalEventID").alias("first_id"))
    told = events.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("GlobalEventID").alias("_id"), "EventCode", "SOURCEURL")
    same = F.col("first_id").eqNullSafe(F.col("_id"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    one = Window.partitionBy(*keys).orderBy("EventCode", "SOURCEURL")
    return (
        told.join(counted, same).withColumn("_place", F.row_number().over(one)).where("_place = 1")
        .select(*keys, "impact", "impacts", "events", F.col("first_id").alias("GlobalEventID"), "EventCode", "SOURCEURL")
    )


def place_counts_of(days: DataFrame) -> DataFrame:
    """``news.place_counts`` from any days; ``news.with_first_event`` then takes the same days for the events."""
    return days.groupBy(*PLACE).agg(
        _mean("impact", "impacts").alias("AvgImpact"), F.sum("events").alias("NumMentions"),
        F.min("GlobalEventID").alias("first_id"))


def geo_analysis_of(days: DataFrame) -> DataFrame:
    """``news.geo_analysis`` from its days."""
    return news.with_first_event(place_counts_of(days), days).orderBy(F.desc("NumMentions"), *PLACE)


def top_event_days(events: DataFrame, n: int) -> DataFrame:
    """The ``n`` most mentioned events of every day, with all that ``news.top_events`` tells of them."""
    order = [news.total_mentions().desc_nulls_last(), F.asc_nulls_last("GlobalEventID")]
    one_day = Window.partitionBy("event_date").orderBy(*order)
    return events.select(
        "event_date", "GlobalEventID", "SOURCEURL", "EventRootCode", "SQLDATE", *PLACE, "NumMentions", "NumSources", "NumArticles",
    ).withColumn("_place", F.row_number().over(one_day)).where(F.col("_place") <= n).drop("_place")


def author_days(posts: DataFrame) -> DataFrame:
    """Sums and counts by day, platform and author, and the time of the author's first post on that day."""
    day = F.col("post_date") if "post_date" in posts.columns else F.to_date("created_at")
    totals = {"engagement": "total_engagement", "likes": "likes_count", "shares": "shares_count",
              "comments": "comments_count", "views": "views_count"}
    return posts.groupBy(day.alias("post_date"), "Platform", "author_id").agg(
        F.count(F.lit(1)).alias("posts"),
        *(F.coalesce(F.sum(column), F.lit(0)).alias(name) for name, column in totals.items()),
        F.count_if("is_sponsored").alias("sponsored"), F.min("created_at").alias("first_at"))


def social_rollup_of(days: DataFrame) -> DataFrame:
    """``social.daily_social_rollup`` from its days."""
    sums = ("posts", "engagement", "likes", "shares", "comments", "views")
    return days.groupBy(F.col("post_date").alias("date")).agg(
        *(F.sum(name).alias(name) for name in sums), F.count_distinct("author_id").alias("uniqueAuthors"),
        (F.sum("sponsored") / F.sum("posts") * 100).alias("sponsoredPercentage"))


def top_authors_of(days: DataFrame, posts: DataFrame, n: int = 10, *, by_platform: bool = False) -> DataFrame:
    """``social.top_authors_engagement`` from its days, and from the posts of the days on which the winners began.

    Those are ``n`` rows and ``n`` days at most, so the driver names the days and the scan reads no other.
    """
    keys = ["Platform", "author_id"] if by_platform else ["author_id"]
    top = (
        days.groupBy(*keys).agg(F.sum("engagement").alias("engagement"), F.to_date(F.min("first_at")).alias("began"))
        .orderBy(F.desc("engagement"), *(F.asc_nulls_last(k) for k in keys)).limit(n)
    )
    rows = top.collect()
    day = F.col("post_date") if "post_date" in posts.columns else F.to_date("created_at")
    began = {row["began"] for row in rows}
    chosen = day.isin(*(F.lit(d) for d in began if d)) if began - {None} else F.lit(False)
    if None in began:
        chosen = chosen | day.isNull()
    winners = days.sparkSession.createDataFrame([tuple(row[c] for c in ("engagement", *keys)) for row in rows],
                                                ", ".join(["engagement long", *(f"{k} string" for k in keys)]))
    return social.first_posts_of(winners, posts.where(chosen), by_platform=by_platform)
