"""Range queries over the derived tables, and the columns each dashboard panel shows.

Ranges are inclusive and apply only when both bounds are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import dates
from tidewatch.functions.dates import Moment
from tidewatch.operators.cubes import place_counts_of
from tidewatch.operators.news import place_counts, with_first_event
from tidewatch.operators.social import platform_engagement_distribution, top_authors_engagement


# Places, of five numbers each, that a request may ask for and still have sent to every task.
BROADCAST_PLACES = 10_000


def _within(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def _iso_date(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", dates.iso_midnight(F.col("Date")))


def _by_day(table: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    chosen = _within(table, dates.day_in_range(F.col("Date"), start, end))
    return _iso_date(chosen).orderBy("Date")


def serve_daily_insights(table: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    return _by_day(table, start, end)


def serve_trend(table: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    return _by_day(table, start, end)


def serve_correlation(table: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    return _by_day(table, start, end)


def serve_geo(table: DataFrame | None, start: Moment | None = None, end: Moment | None = None, *,
              limit: int = 50, events: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """The ``limit`` places with most events.

    The range looks at the date of a place's representative event, over counts of all time.
    Given ``events``, it selects the events that are counted instead; what the representative events say is then fetched
    for the winners alone. ``days``, the cube of ``place_days``, gives the same without reading any event.
    """
    order = [F.desc("NumMentions"), F.asc("ActionGeo_Lat"), F.asc("ActionGeo_Long")]
    if events is None and days is None:
        return _iso_date(_within(table, dates.day_in_range(F.col("Date"), start, end)).orderBy(*order).limit(limit))
    source = events if days is None else days
    day = F.col("event_date") if "event_date" in source.columns else dates.parse_day(F.col("SQLDATE"))
    source = _within(source, dates.day_in_range(day, start, end))
    winners = (place_counts(source) if days is None else place_counts_of(source)).orderBy(*order).limit(limit)
    if limit <= BROADCAST_PLACES:
        winners = F.broadcast(winners)
    return _iso_date(with_first_event(winners, source).orderBy(*order))


def finite_only(df: DataFrame) -> DataFrame:
    """NaN and infinite numbers, at the top level or inside structs, as null."""
    def clean(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            fields = [clean(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*fields))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
        return value

    return df.select(*(clean(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields))


def serve_social_metrics(table: DataFrame) -> DataFrame:
    """All days, unfiltered, with the day as text."""
    return finite_only(table.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


def serve_top_authors(table: DataFrame, start: Moment | None = None, end: Moment | None = None, *,
                      limit: int = 10, posts: DataFrame | None = None, by_platform: bool = False) -> DataFrame:
    """Top authors whose first post falls into the range, out of the table's all-time top.

    Given ``posts``, the range selects the posts that are counted instead, and ``by_platform`` keeps equal ids of
    different platforms apart, as a ``table`` made with it does.
    """
    if posts is not None:
        inside = dates.moment_in_range(F.col("created_at"), start, end)
        table = top_authors_engagement(_within(posts, inside), limit, by_platform=by_platform)
    else:
        table = _within(table, dates.moment_in_range(F.col("Date"), start, end))
    top = table.orderBy(F.desc("engagement"), F.asc_nulls_last("author"), F.asc_nulls_last("Date")).limit(limit)
    return top.withColumn("Date", dates.iso_millis(F.col("Date")))


def serve_platform_distribution(posts: DataFrame, start: Moment | None = None,
                                end: Moment | None = None) -> DataFrame:
    """Computed live from the posts; the interval is (start, end]."""
    return platform_engagement_distribution(posts, start, end)


# The columns each dashboard panel takes and the labels it shows.
PANELS = {
    "event_impact_and_tone": {"Date": "Time", "AvgImpact": "Average Impact", "AvgTone": "Average Tone"},
    "trend": {"Date": "Time", "NumMentions": "Number of Mentions"},
    "geographic_distribution": {
        "ActionGeo_Lat": "Latitude", "ActionGeo_Long": "Longitude", "NumMentions": "Number of Mentions",
        "EventCode": "Event Code", "SOURCEURL": "Source URL",
    },
    "social_engagement": {"date": "Date", "metrics.engagement": "Total Engagement"},
    "top_authors": {"author": "Author", "engagement": "Total Engagement"},
    "platform_distribution": {
        "platform": "Platform", "likes_percentage": "Likes %", "shares_percentage": "Shares %",
        "comments_percentage": "Comments %",
    },
    "mentions_and_engagement": {
        "mentions": "News Mentions", "engagement": "Social Engagement", "Date": "Date",
    },
}


def panel(served: DataFrame, name: str) -> DataFrame:
    """The columns of one panel under their labels."""
    return served.select(*(F.col(path).alias(label) for path, label in PANELS[name].items()))
