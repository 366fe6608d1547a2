"""What the physical plans must and must not contain for the operators to scale."""

import contextlib

import pytest
from pyspark.sql import functions as F
from samples import at, events, posts

from tidewatch.checks.queries import QUERIES
from tidewatch.operators import correlation, keywords, news, search, serving, social
from tidewatch.sources.events import with_event_date

FOLDER = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('_', '.')}": str(v) for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_no_python_and_no_unbounded_broadcast(spark, name):
    with settings(spark, autoBroadcastJoinThreshold=-1):
        text = plan(QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in text
    # The winners of a top-k and the cut-offs of a search are the only sides ever broadcast by hint.
    hinted = "authors" in name or name in ("serve_geo_events_in_range", "serve_geo_days_in_range", "search_posts_capped")
    assert ("BroadcastExchange" in text) == hinted


@pytest.mark.parametrize("name, parser", [
    ("event_rejects", "from_csv("), ("event_dates", "from_csv("), ("normalize_vk", "from_json("),
    ("normalize_tiktok", "from_json("), ("post_hit_counts", "from_json("),
])
def test_each_text_is_parsed_once(spark, name, parser):
    with settings(spark, maxMetadataStringLength=100000, debug_maxToStringFields=100000):
        assert plan(QUERIES[name](spark, FOLDER)).count(parser) == 1


def test_days_are_parsed_after_the_aggregate(spark):
    lines = plan(news.daily_insights(events(spark, dict()))).splitlines()
    first_scan = max(i for i, text in enumerate(lines) if "HashAggregate" in text)
    assert not any("gettimestamp" in text for text in lines[first_scan:])


def test_measures_combine_before_the_shuffle_and_columns_are_pruned(spark, tmp_path):
    with_event_date(events(spark, dict())).write.partitionBy("event_date").parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    text = plan(news.trend_analysis(stored))
    assert "partial_sum(NumMentions" in text and "ReadSchema: struct<NumMentions:int>" in text
    text = plan(news.place_counts(stored))
    assert "partial_min(GlobalEventID" in text
    assert "ReadSchema: struct<GlobalEventID:int,GoldsteinScale:double,ActionGeo_Lat:double,ActionGeo_Long:double>" in text


def test_places_are_counted_without_sorting_events(spark, tmp_path):
    """Numbers are combined in hash tables; what representative events say is fetched for the places alone."""
    frame = with_event_date(events(spark, dict()))
    frame.write.partitionBy("event_date").parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    for found in (news.geo_analysis(stored), serving.serve_geo(None, "2024-01-01", "2024-01-31", events=stored)):
        text = plan(found)
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "HashAggregate" in text
    # A request moves the winners to the events, and no event anywhere but to the choice among its place's first ones.
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("PartitionFilters: [isnotnull(event_date") == 2


def test_a_live_range_reaches_the_files(spark, tmp_path):
    posts(spark, dict()).write.parquet(str(tmp_path / "p"))
    text = plan(serving.serve_platform_distribution(
        spark.read.parquet(str(tmp_path / "p")), "2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z"))
    assert "GreaterThan(created_at" in text and "LessThanOrEqual(created_at" in text
    assert "ReadSchema: struct<Platform:string,created_at:timestamp,likes_count:bigint" in text


def test_a_day_range_prunes_the_partitions_of_a_derived_table(spark, tmp_path):
    paired = correlation.news_social_correlation(events(spark, dict()), posts(spark, dict()))
    paired.write.partitionBy("Date").parquet(str(tmp_path / "c"))
    served = serving.serve_correlation(spark.read.parquet(str(tmp_path / "c")), "2024-01-01", "2024-01-31")
    assert "PartitionFilters: [isnotnull(Date" in plan(served)


@pytest.mark.parametrize("frame", [
    lambda s: news.top_events(events(s, dict()), 20), lambda s: social.top_authors_engagement(posts(s, dict())),
    lambda s: serving.serve_geo(news.geo_analysis(events(s, dict()))),
])
def test_top_k_never_sorts_everything(spark, frame):
    assert "TakeOrderedAndProject" in plan(frame(spark))


def test_the_cap_moves_only_posts_of_the_cut_off_second(spark):
    """Before them lie counts per second, and posts that are filtered by a cut-off on their way out of the scan."""
    with settings(spark, adaptive_enabled="false"):
        text = plan(search.search_posts(posts(spark, dict()), None, "2024-01-01", "2024-01-31", limit=10_000))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    ranked = [line for line in exchanges if "_slice" in line]
    assert len(ranked) == 3 and all("_second" in line or "window_start" in line for line in exchanges)
    early, tied = text.split("_slice", 1)[0], text.rsplit("_slice", 1)[1]
    assert "Window" in early and "BroadcastHashJoin" in early and "BroadcastHashJoin" in tied
    assert "BroadcastHashJoin [_at#" in tied  # the cut-off second is part of the join


def test_a_hot_url_and_a_hot_token_are_split(spark):
    """A third of all rows share one URL; with tiny thresholds AQE must split its partition."""
    lexicon = spark.createDataFrame([("storm", "NOUN", "storm")], "token string, pos string, lemma string")
    rows = spark.range(0, 60000, 1, 8).select("id", F.when(
        F.col("id") % 3 == 0, F.lit("https://x.org/storm-hits-coast")
    ).otherwise(F.concat(F.lit("https://x.org/storm-number-"), F.col("id").cast("string"), F.lit("-again"))).alias("SOURCEURL"))
    with settings(spark, autoBroadcastJoinThreshold=-1, adaptive_autoBroadcastJoinThreshold=-1,
                  adaptive_advisoryPartitionSizeInBytes="64k", adaptive_skewJoin_skewedPartitionThresholdInBytes="64k",
                  adaptive_skewJoin_skewedPartitionFactor="2", adaptive_coalescePartitions_enabled="false"):
        found = keywords.extract_keywords(rows, lexicon=lexicon, stop_words=[])
        counts = {r["k"]: r["n"] for r in found.select(F.array_join("Keywords", " ").alias("k"))
                  .groupBy("k").agg(F.count("*").alias("n")).collect()}
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        text = plan(found)
    assert counts == {"storm hits coast": 20000, "storm number again": 40000}
    assert text.count("SortMergeJoin(skew=true)") >= 2


def test_hot_groups_lose_no_rows(spark):
    """One day, one place and one author hold most rows."""
    crowd = events(spark, dict()).crossJoin(spark.range(0, 30000, 1, 8)).withColumn(
        "GlobalEventID", F.col("id").cast("int"))
    assert news.daily_insights(crowd).first()["NumMentions"] == 30000
    place = news.geo_analysis(crowd).first()
    assert (place["NumMentions"], place["SOURCEURL"]) == (30000, "https://x.org/one")
    talk = posts(spark, dict(created_at=at("2024-01-05T00:00:00"))).crossJoin(spark.range(0, 30000, 1, 8))
    assert social.top_authors_engagement(talk).first()["engagement"] == 180000
