"""Aggregates over world events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.operators.keywords import extract_keywords, rank_keywords


def _day_key(events: DataFrame) -> tuple[Column, Column]:
    """Grouping key of an event's day, and the date as a function of the grouped ``_day``.

    An ingested table carries ``event_date``. Without it the key is the day text, so the
    text is parsed once per group instead of once per event. The date names the group's
    count: a filter on it would otherwise be pushed below the aggregate and undo that.
    """
    if "event_date" in events.columns:
        return F.col("event_date"), F.col("_day")
    return dates.day_text(F.col("SQLDATE")), F.when(F.col("events") > 0, dates.parse_day(F.col("_day")))


def _by_day(events: DataFrame, **measures: Column) -> DataFrame:
    """``Date, events`` and the measures; events without a valid day belong to no group."""
    key, day = _day_key(events)
    return (
        events.groupBy(key.alias("_day"))
        .agg(F.count(F.lit(1)).alias("events"), *(m.alias(name) for name, m in measures.items()))
        .select(day.alias("Date"), "events", *measures)
        .where(F.col("Date").isNotNull())
    )


def _mentions() -> Column:
    return F.coalesce(F.sum("NumMentions"), F.lit(0))


def daily_news_rollup(events: DataFrame) -> DataFrame:
    """Every daily measure in one pass: ``Date, events, AvgImpact, AvgTone, mentions``."""
    return _by_day(events, AvgImpact=F.avg("GoldsteinScale"), AvgTone=F.avg("AvgTone"), mentions=_mentions())


def insights_of(rollup: DataFrame) -> DataFrame:
    return rollup.select("Date", "AvgImpact", "AvgTone", F.col("events").alias("NumMentions")).orderBy("Date")


def trend_of(rollup: DataFrame) -> DataFrame:
    return rollup.select("Date", F.col("mentions").alias("NumMentions")).orderBy("Date")


def mentions_of(rollup: DataFrame) -> DataFrame:
    return rollup.select("Date", F.col("mentions").alias("total_mentions"))


def daily_insights(events: DataFrame) -> DataFrame:
    """Mean impact and tone per day; ``NumMentions`` is the number of events."""
    return insights_of(daily_news_rollup(events))


def trend_analysis(events: DataFrame) -> DataFrame:
    """Sum of the mention counts per day."""
    return trend_of(_by_day(events, mentions=_mentions()))


def news_daily_mentions(events: DataFrame) -> DataFrame:
    """Mentions per day: the news side of the day-by-day pairing."""
    return _by_day(events, total_mentions=_mentions()).drop("events")


def place_counts(events: DataFrame) -> DataFrame:
    """Events per exact coordinate pair with mean impact, and the lowest id among them as ``first_id``.

    Only numbers of fixed width, so tasks combine them in a hash table, without sorting.
    """
    return (
        events.where(F.col("ActionGeo_Lat").isNotNull() & F.col("ActionGeo_Long").isNotNull())
        .groupBy("ActionGeo_Lat", "ActionGeo_Long")
        .agg(
            F.avg("GoldsteinScale").alias("AvgImpact"),
            F.count(F.lit(1)).alias("NumMentions"),
            F.min("GlobalEventID").alias("first_id"),
        )
    )


def with_first_event(places: DataFrame, events: DataFrame) -> DataFrame:
    """``place_counts``, or some of its rows, with code, URL and date of each place's event of the lowest id.

    What an event says is fetched for these places alone. An id that a repeated load brought again, and a place whose
    events have no id, give their lowest code, URL and day; every task sends one row of a place for that choice.
    """
    typed = "event_date" in events.columns
    told = events.select(
        F.col("ActionGeo_Lat").alias("_lat"), F.col("ActionGeo_Long").alias("_long"), F.col("GlobalEventID").alias("_id"),
        "EventCode", "SOURCEURL", (F.col("event_date") if typed else F.col("SQLDATE")).alias("_day"),
    ).where(F.col("_lat").isNotNull() & F.col("_long").isNotNull())
    same = ((F.col("ActionGeo_Lat") == F.col("_lat")) & (F.col("ActionGeo_Long") == F.col("_long"))
            & F.col("first_id").eqNullSafe(F.col("_id")))
    one = Window.partitionBy("ActionGeo_Lat", "ActionGeo_Long").orderBy("EventCode", "SOURCEURL", "_day")
    return (
        told.join(places, same)
        .withColumn("_place", F.row_number().over(one)).where("_place = 1")
        .select(
            "ActionGeo_Lat", "ActionGeo_Long", "AvgImpact", "NumMentions", "EventCode", "SOURCEURL",
            (F.col("_day") if typed else dates.parse_day(F.col("_day"))).alias("Date"),
        )
    )


def geo_analysis(events: DataFrame) -> DataFrame:
    """Events per exact coordinate pair with mean impact and one representative event, that with the lowest id."""
    return with_first_event(place_counts(events), events).orderBy(
        F.desc("NumMentions"), "ActionGeo_Lat", "ActionGeo_Long")


def total_mentions() -> Column:
    """Mentions, sources and articles together; null when any of them is."""
    return F.col("NumMentions").cast("long") + F.col("NumSources") + F.col("NumArticles")


def top_events(events: DataFrame, n: int) -> DataFrame:
    """The ``n`` events with most total mentions, lower id first among equals."""
    return (
        events.select(
            "GlobalEventID",
            F.col("SOURCEURL").alias("SourceURL"),
            "EventRootCode", "SQLDATE",
            total_mentions().alias("TotalMentions"),
            "ActionGeo_Lat", "ActionGeo_Long", "NumMentions", "NumSources", "NumArticles",
        )
        .orderBy(F.desc_nulls_last("TotalMentions"), F.asc_nulls_last("GlobalEventID"))
        .limit(n)
    )


def top_mentions_of(keyed: DataFrame, n: int = 10) -> DataFrame:
    """Report of the first ``n`` of ``top_events`` that carry ``Keywords``."""
    return (
        keyed.orderBy(F.desc_nulls_last("TotalMentions"), F.asc_nulls_last("GlobalEventID"))
        .limit(n)
        .select(
            "SourceURL", "EventRootCode",
            dates.parse_day_strict(F.col("SQLDATE")).alias("Date"),
            "TotalMentions",
            F.struct(F.col("ActionGeo_Lat").alias("Latitude"),
                     F.col("ActionGeo_Long").alias("Longitude")).alias("Location"),
            "NumMentions", "NumSources", "NumArticles", "Keywords",
        )
    )


def keyword_ranking_of(keyed: DataFrame) -> DataFrame:
    """Keyword counts over ``top_events`` that carry ``Keywords``, in their order."""
    place = F.struct(
        F.col("TotalMentions").isNull().alias("uncounted"),
        (-F.col("TotalMentions")).alias("falling"),
        F.col("GlobalEventID").isNull().alias("unnumbered"),
        "GlobalEventID",
    )
    return rank_keywords(keyed, "Keywords", place)


def top_mentions(events: DataFrame, n: int = 10, **keyword_options) -> DataFrame:
    """The ``n`` most mentioned events with location and URL keywords."""
    return top_mentions_of(extract_keywords(top_events(events, n), "SourceURL", **keyword_options), n)


def top_mentions_keywords(events: DataFrame, n: int = 20, **keyword_options) -> DataFrame:
    """Keyword counts over the URLs of the ``n`` most mentioned events; a repeated URL counts again."""
    return keyword_ranking_of(extract_keywords(top_events(events, n), "SourceURL", **keyword_options))
