"""Day-by-day pairing of news and social activity, and the upsert that maintains it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.news import news_daily_mentions
from tidewatch.operators.social import social_daily_engagement


def pair_days(news_daily: DataFrame, social_daily: DataFrame) -> DataFrame:
    """``Date, mentions, engagement`` for the days both sides have; one row per side and day."""
    return (
        news_daily.join(social_daily, "Date")
        .select("Date", F.col("total_mentions").alias("mentions"), F.col("total_engagement").alias("engagement"))
        .orderBy("Date")
    )


def news_social_correlation(events: DataFrame, posts: DataFrame) -> DataFrame:
    """Mentions next to engagement per day; no coefficient is computed."""
    return pair_days(news_daily_mentions(events), social_daily_engagement(posts))


def upsert_by_date(old: DataFrame, new: DataFrame, key: str = "Date") -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose date ``new`` does not produce; a null date stands for no date.

    Both sides are read once: rows of one date meet, and the old ones go where a new one is among them.
    """
    rows = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    renewed = F.max("_new").over(Window.partitionBy(key))
    return (rows.withColumn("_renewed", renewed)
            .where(F.col("_new") | ~F.col("_renewed") | F.col(key).isNull()).drop("_new", "_renewed"))
