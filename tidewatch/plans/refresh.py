"""Raw files to tables, and tables to derived tables.

Each group of derived tables shares its scans: one daily rollup of the events feeds three
tables, one daily rollup of the posts feeds two, and the most mentioned events are found
once for report and ranking. Only those small results are checkpointed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import correlation, news, social
from tidewatch.operators.keywords import extract_keywords
from tidewatch.operators.normalize import normalize, union_posts
from tidewatch.schemas import CORRUPT_COLUMN, PLATFORMS
from tidewatch.session import cut_lineage
from tidewatch.sinks.tables import (
    Status, append_rows, place_order, replace_loads, replace_partitions, replace_table, write_status,
)
from tidewatch.sources import events as event_source
from tidewatch.sources import posts as post_source

REPORTED_EVENTS = 10
RANKED_EVENTS = 20
# Within a partition, rows lie in the order their readers filter by.
EVENT_ID, POST_ID = ["GlobalEventID"], ["post_id"]
POST_ORDER = ["created_at", "post_id"]


def event_order() -> list[Column]:
    """Events that are near each other lie together, so that a box skips row groups by either coordinate."""
    return [place_order("ActionGeo_Lat", "ActionGeo_Long"), F.col("GlobalEventID")]


def file_load(path: str = "_metadata.file_path") -> Column:
    """The name under which a file's rows are stored: of its whole path, as equal names occur in many folders."""
    # Listings write local paths with one slash, scans with three.
    plain = F.regexp_replace(path, "^file:/+", "file:/")
    return F.concat(F.lit("f"), F.sha1(plain.cast("binary")))


def _load_names(spark: SparkSession, files: list[str]) -> list[str]:
    names = spark.createDataFrame([(f,) for f in files], "path string").select(file_load("path"))
    return [row[0] for row in names.collect()]


def _saved(rows: DataFrame, path: str, partition_by: list[str], replaces: list[str] | None, *,
           sort_by: list[str | Column] | None = None, find_by: list[str] | None = None) -> int:
    """Append, or with names of loads, take their place."""
    layout = {"sort_by": sort_by, "find_by": find_by}
    if replaces is None:
        return append_rows(rows, path, partition_by, **layout)
    return replace_loads(rows, path, partition_by, replaces, spark=rows.sparkSession, **layout)


def load_events(spark: SparkSession, paths: str | list[str], root: str, *, by_file: bool = False) -> list[Status]:
    """Day files into the event and reject tables, counted and written in one pass.

    A repeated load appends its rows again unless ``by_file``, where it replaces all rows of
    the same files, also those of days a corrected file no longer has. A load that fails
    leaves the rows that these files gave before.
    """
    raw = event_source.read_events(spark, paths, keep_corrupt=True)
    replaces = _load_names(spark, raw.inputFiles()) if by_file else None
    return save_events(raw.withColumn("load", file_load() if by_file else F.lit(f"a{uuid.uuid4().hex}")), root, replaces)


def save_events(raw: DataFrame, root: str, replaces: list[str] | None = None) -> list[Status]:
    """Raw rows with their ``load`` into the event and reject partitions of one table.

    With ``replaces``, what these loads gave before goes once the new rows are complete.
    """
    raw, read = event_source.counted(raw, "read")
    rows = event_source.routed(event_source.with_audit(raw))
    kinds = Observation("kinds")
    rows = rows.observe(kinds, *(F.count_if(F.col("kind") == k).alias(k) for k in ("events", "rejects")))
    parts = ["kind", "load", "event_date"]
    written = write_status("events", lambda: _saved(
        rows, f"{root}/raw_events", parts, replaces, sort_by=event_order(), find_by=EVENT_ID), empty_ok=True)
    if not written.ok:
        return [written]
    events = event_source.seen(kinds, "events")
    return [
        Status("events_read", event_source.seen(read), True),
        Status("events", events, events > 0),
        Status("event_rejects", event_source.seen(kinds, "rejects"), True),
    ]


def stored_events(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "events").drop(CORRUPT_COLUMN, "reject_reason")


def stored_rejects(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "rejects").drop("event_date")


def _stored(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{root}/raw_events").where(F.col("kind") == kind).drop("kind", "load")


def stored_posts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/posts").drop("load")


def load_posts(spark: SparkSession, paths: str | list[str], root: str,
               platforms: list[str] | tuple[str, ...] = PLATFORMS,
               options: dict[str, dict] | None = None, *, by_file: bool = False) -> list[Status]:
    """Post archives into ``posts``, partitioned by platform, load and day.

    Statuses tell the hits read of each platform, the files that hold fewer hits than they
    announce, and the broken files, whose text goes to ``post_rejects``. ``by_file`` replaces
    what the same files gave before.
    """
    load = file_load("file_path") if by_file else F.lit(f"a{uuid.uuid4().hex}")
    envelopes = {p: post_source.read_envelopes(spark, paths, p, keep_corrupt=True).withColumn("load", load)
                 for p in platforms}
    replaces = _load_names(spark, sorted({f for e in envelopes.values() for f in e.inputFiles()})) if by_file else None
    return save_posts(envelopes, root, options, replaces)


def save_posts(envelopes: dict[str, DataFrame], root: str, options: dict[str, dict] | None = None,
               replaces: list[str] | None = None) -> list[Status]:
    """Envelopes per platform, with their ``load``, into posts and rejects; the latter are read again only if there are any.

    With ``replaces``, what these loads gave before goes, table by table, once the new rows are complete.
    """
    marks, parts, rejects = {}, [], []
    for platform, files in envelopes.items():
        rejects.append(post_source.broken_files(files).withColumn("Platform", F.lit(platform)))
        total, held = post_source.announced_and_held(files)
        marks[platform] = Observation(f"{platform}_files")
        files = files.observe(marks[platform], F.sum(held).alias("read"), F.count_if(total > held).alias("truncated"),
                              F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("rejects"))
        parts.append(normalize(post_source.unnest_hits(files, "load"), platform, **(options or {}).get(platform, {})))
    posts = union_posts(*parts).withColumn("post_date", F.to_date("created_at"))
    partitions = ["Platform", "load", "post_date"]
    written = write_status("posts", lambda: _saved(
        posts, f"{root}/posts", partitions, replaces, sort_by=POST_ORDER, find_by=POST_ID))
    if written.error:
        return [written]
    found = {kind: {p: event_source.seen(mark, kind) for p, mark in marks.items()} for kind in ("read", "truncated")}
    broken = Status("post_rejects", 0, True)
    # Where no file had a hit, nothing was counted on the way either.
    if any(event_source.seen(mark, "rejects", None) != 0 for mark in marks.values()):
        broken = write_status("post_rejects", lambda: _saved(
            reduce(DataFrame.unionByName, rejects), f"{root}/post_rejects", ["Platform", "load"], replaces), empty_ok=True)
    elif replaces:
        replace_loads(None, f"{root}/post_rejects", ["Platform", "load"], replaces, spark=posts.sparkSession)
    return [Status(f"{p}_read", n, True) for p, n in found["read"].items()] + [
        Status(f"{p}_truncated", n, True) for p, n in found["truncated"].items() if n] + [broken, written]


def shared_rollup(events: DataFrame, root: str) -> Callable[[], DataFrame]:
    """The daily rollup of the events, computed when first asked for."""
    return cache(lambda: cut_lineage(news.daily_news_rollup(events), f"{root}/_checkpoints"))


def refresh_news(events: DataFrame | None, root: str, rollup: Callable[[], DataFrame] | None = None, *,
                 places: Callable[[], DataFrame] | None = None, top: Callable[[], DataFrame] | None = None,
                 **keyword_options) -> tuple[list[Status], DataFrame | None]:
    """Daily insights, places, trend, most mentioned events.

    Returns the statuses and the keyword ranking, None if the latter cannot be computed. ``rollup``, ``places`` and
    ``top`` stand in for what is computed from the events otherwise.
    """
    rollup = rollup or shared_rollup(events, root)
    places = places or (lambda: news.geo_analysis(events))
    top = top or (lambda: news.top_events(events, RANKED_EVENTS))

    @cache
    def keyed() -> DataFrame:
        return cut_lineage(extract_keywords(top(), "SourceURL", **keyword_options), f"{root}/_checkpoints")

    statuses = [
        write_status("daily_insights", lambda: replace_table(news.insights_of(rollup()), f"{root}/daily_insights", sort_by=["Date"])),
        write_status("geo_analysis", lambda: replace_table(
            places(), f"{root}/geo_analysis", sort_by=[F.desc("NumMentions"), "ActionGeo_Lat", "ActionGeo_Long"])),
        write_status("trend_analysis", lambda: replace_table(news.trend_of(rollup()), f"{root}/trend_analysis", sort_by=["Date"])),
        write_status(
            "top_mentions",
            lambda: replace_table(news.top_mentions_of(keyed(), REPORTED_EVENTS), f"{root}/top_mentions"),
            empty_ok=True,
        ),
    ]
    return statuses, news.keyword_ranking_of(keyed()) if statuses[-1].error is None else None


def refresh_social(events: DataFrame | None, posts: DataFrame, root: str,
                   mentions: Callable[[], DataFrame] | None = None, *, rollup: Callable[[], DataFrame] | None = None,
                   authors: Callable[[], DataFrame] | None = None) -> list[Status]:
    """Daily metrics, top authors, and the upsert of the day-by-day pairing.

    ``mentions`` gives the rollup that ``refresh_news`` used, which saves a scan of the events. ``rollup`` and ``authors``
    stand in for what is computed from the posts otherwise.
    """
    rollup = rollup or cache(lambda: cut_lineage(social.daily_social_rollup(posts), f"{root}/_checkpoints"))
    authors = authors or (lambda: social.top_authors_engagement(posts))

    def pair() -> int:
        paired = correlation.pair_days(
            news.mentions_of(mentions()) if mentions else news.news_daily_mentions(events), social.engagement_of(rollup()))
        return replace_partitions(paired, f"{root}/news_social_correlation", ["Date"])

    return [
        write_status(
            "social_temporal_metrics",
            lambda: replace_table(social.metrics_of(rollup()), f"{root}/social_temporal_metrics"),
        ),
        write_status(
            "top_authors_engagement",
            lambda: replace_table(authors(), f"{root}/top_authors_engagement", sort_by=[F.desc("engagement")]),
        ),
        write_status("news_social_correlation", pair),
    ]


def refresh_all(events: DataFrame, posts: DataFrame, root: str,
                **keyword_options) -> tuple[list[Status], DataFrame | None]:
    """Every derived table, events first; returns statuses and the keyword ranking."""
    rollup = shared_rollup(events, root)
    statuses, ranking = refresh_news(events, root, rollup, **keyword_options)
    shared = None if any(s.error for s in statuses if s.table in ("daily_insights", "trend_analysis")) else rollup
    return statuses + refresh_social(events, posts, root, shared), ranking


def succeeded(statuses: list[Status]) -> bool:
    return all(status.ok for status in statuses)
