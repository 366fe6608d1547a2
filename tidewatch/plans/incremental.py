"""Derived tables kept up to date from the days that changed.

For every day the names of its stored files are remembered, whoever wrote them. Days whose names differ are computed anew
into the cubes, from these days alone; days without files leave them. The derived tables are then merged from the cubes.
What was remembered is replaced last, so a refresh that breaks off is made again as a whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import cubes, news
from tidewatch.plans import refresh
from tidewatch.session import cut_lineage
from tidewatch.sinks.publish import Files
from tidewatch.sinks.tables import Status, replace_days

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
STATE = "days.json"


class Changes(NamedTuple):
    """Days to compute, and the names that stand for all days once that is done."""

    days: list[str]
    names: dict[str, str]


def _cube(root: str, name: str) -> str:
    return f"{root}/cubes/{name}"


def _changes(files: list[str], column: str, known: dict[str, str]) -> Changes:
    found = defaultdict(list)
    for file in files:
        day = re.search(rf"/{column}=([^/]+)/", file)
        if day:
            found[unquote(day.group(1))].append(file.rsplit("/", 3)[-3] + "/" + file.rsplit("/", 1)[-1])
    names = {day: hashlib.sha1("\n".join(sorted(of)).encode()).hexdigest() for day, of in found.items()}
    return Changes(sorted(d for d in names.keys() | known.keys() if names.get(d) != known.get(d)), names)


def changed_days(spark: SparkSession, root: str) -> dict[str, Changes]:
    """Days of the event and post tables that are not as the last refresh saw them."""
    state = Files(spark, f"{root}/cubes")
    known = json.loads(state.read(STATE)) if state.exists(STATE) else {}
    events = [f for f in _files(spark, f"{root}/raw_events") if "/kind=events/" in f]
    return {"events": _changes(events, "event_date", known.get("events", {})),
            "posts": _changes(_files(spark, f"{root}/posts"), "post_date", known.get("posts", {}))}


def _files(spark: SparkSession, path: str) -> list[str]:
    return list(spark.read.parquet(path).inputFiles()) if Files(spark, path).folders() else []


def _in(column: str, days: list[str]) -> Column:
    dated = [F.to_date(F.lit(d)) for d in days if d != NO_DAY]
    chosen = F.col(column).isin(*dated) if dated else F.lit(False)
    return chosen | F.col(column).isNull() if NO_DAY in days else chosen


def _update(cube: DataFrame, root: str, name: str, column: str, days: list[str]) -> None:
    replace_days(cube, _cube(root, name), column, days)


def update_cubes(spark: SparkSession, root: str) -> dict[str, Changes]:
    """Compute the changed days of every cube, and only those; returns what had changed."""
    changes = changed_days(spark, root)
    days = changes["events"].days
    if days:
        events = refresh.stored_events(spark, root).where(_in("event_date", days))
        _update(cubes.news_days(events), root, "news_days", "event_date", days)
        _update(cubes.place_days(events), root, "place_days", "event_date", days)
        _update(cubes.top_event_days(events, refresh.RANKED_EVENTS), root, "top_event_days", "event_date", days)
    days = changes["posts"].days
    if days:
        posts = refresh.stored_posts(spark, root).where(_in("post_date", days))
        _update(cubes.author_days(posts), root, "author_days", "post_date", days)
    if any(c.days for c in changes.values()):
        Files(spark, f"{root}/cubes").replace(STATE, json.dumps({table: c.names for table, c in changes.items()}))
    return changes


def read_cube(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A cube as ``serving`` and the functions of ``cubes`` take it."""
    return spark.read.parquet(_cube(root, name))


def refresh_changed(spark: SparkSession, root: str, **keyword_options) -> tuple[list[Status], DataFrame | None]:
    """All derived tables, as ``refresh_all`` leaves them, from the cubes after ``update_cubes``."""
    update_cubes(spark, root)
    posts = refresh.stored_posts(spark, root)
    rollup = refresh.cache(lambda: cut_lineage(cubes.rollup_of(read_cube(spark, root, "news_days")), f"{root}/_checkpoints"))
    social_rollup = refresh.cache(
        lambda: cut_lineage(cubes.social_rollup_of(read_cube(spark, root, "author_days")), f"{root}/_checkpoints"))
    statuses, ranking = refresh.refresh_news(
        None, root, rollup, places=lambda: cubes.geo_analysis_of(read_cube(spark, root, "place_days")),
        top=lambda: news.top_events(read_cube(spark, root, "top_event_days"), refresh.RANKED_EVENTS), **keyword_options)
    return statuses + refresh.refresh_social(
        None, posts, root, rollup, rollup=social_rollup,
        authors=lambda: cubes.top_authors_of(read_cube(spark, root, "author_days"), posts)), ranking
