"""One query per operator, over the whole driver tables.

Outputs are flat: days as text, structs as columns, arrays joined, means rounded, so that
both engines hash the same scalars. Adding 0.0 turns a rounded -0.0 into 0.0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.checks import fixtures as fx
from tidewatch.functions import tags, urls
from tidewatch.operators import correlation, cubes, dedup, keywords, news, normalize, search, serving, social
from tidewatch.schemas import EVENT_SCHEMA
from tidewatch.sinks.tables import to_documents
from tidewatch.sources import events as event_source
from tidewatch.sources import manifest
from tidewatch.sources import posts as post_source

RANGE = ("2024-01-05T00:00:00.000Z", "2024-01-20T12:00:00.000Z")
WORDS = {"stop_words": fx.STOP_WORDS}
FIRST_HOURS = ("2024-01-01T00:00:00.000Z", "2024-01-01T08:00:00.000Z")
MONTH = ("2024-01-01", "2024-01-31")
CAP = 50

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(name: str) -> Column:
    return (F.round(F.col(name), 6) + F.lit(0.0)).alias(name)


def day(name: str = "Date") -> Column:
    return F.date_format(F.col(name), "yyyy-MM-dd").alias(name)


def second(name: str) -> Column:
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name)


def joined(name: str) -> Column:
    return F.array_join(F.col(name), "|").alias(name)


# Derived tables ---------------------------------------------------------------------------

@query
def daily_insights(spark, folder):
    return news.daily_insights(fx.news_without_urls(spark, folder)).select(
        day(), rounded("AvgImpact"), rounded("AvgTone"), "NumMentions")


@query
def geo_analysis(spark, folder):
    return news.geo_analysis(fx.news(spark, folder)).select(
        "ActionGeo_Lat", "ActionGeo_Long", rounded("AvgImpact"), "NumMentions", "EventCode", "SOURCEURL", day())


@query
def trend_analysis(spark, folder):
    return news.trend_analysis(fx.news_without_urls(spark, folder)).select(day(), "NumMentions")


@query
def top_mentions(spark, folder):
    return news.top_mentions(fx.news(spark, folder), **WORDS).select(
        "SourceURL", "EventRootCode", day(), "TotalMentions", "Location.Latitude", "Location.Longitude",
        "NumMentions", "NumSources", "NumArticles", joined("Keywords"))


@query
def top_mentions_keywords(spark, folder):
    return news.top_mentions_keywords(fx.news(spark, folder), **WORDS).select("keyword", "n")


@query
def social_temporal_metrics(spark, folder):
    return social.social_temporal_metrics(fx.posts(spark, folder)).select(day("date"), "metrics.*").select(
        "date", "posts", "engagement", "likes", "shares", "comments", "views", "uniqueAuthors",
        rounded("sponsoredPercentage"))


@query
def top_authors_engagement(spark, folder):
    return social.top_authors_engagement(fx.posts(spark, folder)).select("author", "engagement", second("Date"))


@query
def top_authors_by_platform(spark, folder):
    return social.top_authors_engagement(fx.posts(spark, folder), by_platform=True).select(
        "Platform", "author", "engagement", second("Date"))


@query
def news_daily_mentions(spark, folder):
    return news.news_daily_mentions(fx.news_without_urls(spark, folder)).select(day(), "total_mentions")


@query
def social_daily_engagement(spark, folder):
    return social.social_daily_engagement(fx.posts(spark, folder)).select(day(), "total_engagement")


@query
def news_social_correlation(spark, folder):
    return correlation.news_social_correlation(fx.news_without_urls(spark, folder), fx.posts(spark, folder)).select(
        day(), "mentions", "engagement")


def _shares(df: DataFrame) -> DataFrame:
    return df.select("platform", *(rounded(f"{p}_percentage") for p in ("likes", "shares", "comments")))


@query
def platform_engagement_distribution(spark, folder):
    return _shares(social.platform_engagement_distribution(fx.posts(spark, folder)))


@query
def upsert_by_date(spark, folder):
    new = correlation.news_social_correlation(fx.news_without_urls(spark, folder), fx.posts(spark, folder))
    old = news.daily_news_rollup(fx.news_without_urls(spark, folder)).select(
        F.date_add("Date", 5).alias("Date"), "mentions", F.lit(-1).cast("long").alias("engagement"))
    return correlation.upsert_by_date(old, new).select(day(), "mentions", "engagement")


# Serving ----------------------------------------------------------------------------------

@query
def serve_daily_insights_range(spark, folder):
    return serving.serve_daily_insights(news.daily_insights(fx.news_without_urls(spark, folder)), *RANGE).select(
        "Date", rounded("AvgImpact"), rounded("AvgTone"), "NumMentions")


@query
def serve_geo_top50_range(spark, folder):
    return serving.serve_geo(news.geo_analysis(fx.news(spark, folder)), *RANGE).select(
        "ActionGeo_Lat", "ActionGeo_Long", rounded("AvgImpact"), "NumMentions", "EventCode", "SOURCEURL", "Date")


@query
def serve_geo_events_in_range(spark, folder):
    return serving.serve_geo(None, *RANGE, events=fx.news(spark, folder)).select(
        "ActionGeo_Lat", "ActionGeo_Long", rounded("AvgImpact"), "NumMentions", "EventCode", "SOURCEURL", "Date")


@query
def serve_trend_range(spark, folder):
    return serving.serve_trend(news.trend_analysis(fx.news_without_urls(spark, folder)), *RANGE)


@query
def serve_social_metrics(spark, folder):
    served = serving.serve_social_metrics(social.social_temporal_metrics(fx.posts(spark, folder)))
    return served.select("date", "metrics.*").select(
        "date", "posts", "engagement", "likes", "shares", "comments", "views", "uniqueAuthors",
        rounded("sponsoredPercentage"))


@query
def serve_top_authors_range(spark, folder):
    return serving.serve_top_authors(social.top_authors_engagement(fx.posts(spark, folder)), *RANGE)


@query
def serve_top_authors_posts_in_range(spark, folder):
    return serving.serve_top_authors(None, *RANGE, posts=fx.posts(spark, folder))


@query
def serve_platform_distribution_range(spark, folder):
    return _shares(serving.serve_platform_distribution(fx.posts(spark, folder), *RANGE))


@query
def serve_correlation_range(spark, folder):
    paired = correlation.news_social_correlation(fx.news_without_urls(spark, folder), fx.posts(spark, folder))
    return serving.serve_correlation(paired, *RANGE)


@query
def panel_event_impact_and_tone(spark, folder):
    shown = serving.panel(
        serving.serve_daily_insights(news.daily_insights(fx.news_without_urls(spark, folder))), "event_impact_and_tone")
    return shown.select("Time", rounded("Average Impact"), rounded("Average Tone"))


@query
def panel_trend(spark, folder):
    return serving.panel(serving.serve_trend(news.trend_analysis(fx.news_without_urls(spark, folder))), "trend")


@query
def panel_geographic_distribution(spark, folder):
    return serving.panel(
        serving.serve_geo(news.geo_analysis(fx.news(spark, folder)), *RANGE), "geographic_distribution")


@query
def panel_social_engagement(spark, folder):
    return serving.panel(
        serving.serve_social_metrics(social.social_temporal_metrics(fx.posts(spark, folder))), "social_engagement")


@query
def panel_top_authors(spark, folder):
    return serving.panel(
        serving.serve_top_authors(social.top_authors_engagement(fx.posts(spark, folder)), *RANGE), "top_authors")


@query
def panel_platform_distribution(spark, folder):
    shown = serving.panel(
        serving.serve_platform_distribution(fx.posts(spark, folder), *RANGE), "platform_distribution")
    return shown.select("Platform", *(rounded(c) for c in ("Likes %", "Shares %", "Comments %")))


@query
def panel_mentions_and_engagement(spark, folder):
    paired = correlation.news_social_correlation(fx.news_without_urls(spark, folder), fx.posts(spark, folder))
    return serving.panel(serving.serve_correlation(paired, *RANGE), "mentions_and_engagement")


# Ingest -----------------------------------------------------------------------------------

def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The news events as raw lines, some of them cut short or with a bad number or day."""
    events = fx.news(spark, folder)
    key = F.col("GlobalEventID")
    values = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in events.columns}
    values["NumMentions"] = F.when(key % 73 == 0, "many").otherwise(values["NumMentions"])
    values["SQLDATE"] = F.when(key % 67 == 0, "20240199").otherwise(values["SQLDATE"])
    values["Actor1Name"] = F.concat(F.lit('"'), F.col("EventCode"))
    fields = [values.get(name, F.lit("")) for name in EVENT_SCHEMA.names]
    return events.select(
        F.when(key % 71 == 0, F.concat_ws("\t", *fields[:3])).otherwise(F.concat_ws("\t", *fields)).alias("value"))


@query
def event_tsv_parse(spark, folder):
    return event_source.parse_event_lines(event_lines(spark, folder)).select(
        "GlobalEventID", "SQLDATE", "Actor1Name", "EventCode", "GoldsteinScale", "NumMentions", "AvgTone",
        "ActionGeo_Lat", "SOURCEURL")


@query
def event_rejects(spark, folder):
    parsed = event_source.parse_event_lines(event_lines(spark, folder), keep_corrupt=True)
    return event_source.split_rejects(parsed)[1].select("GlobalEventID", "reject_reason")


@query
def event_dates(spark, folder):
    parsed = event_source.parse_event_lines(event_lines(spark, folder), keep_corrupt=True)
    return event_source.split_rejects(parsed)[0].select("GlobalEventID", day("event_date"))


def envelopes(spark: SparkSession, folder: str, platform: str) -> DataFrame:
    """The posts of one platform as raw search results, one hit each."""
    posts = fx.posts(spark, folder).where(F.col("Platform") == platform)
    words = F.split("content", " ")
    named = F.transform(tags.text_tags(F.col("content"), strip_hash=True), lambda t: F.struct(t.alias("name")))
    if platform == "tiktok_video":
        source = F.struct(
            F.col("post_id").alias("id"), F.col("content").alias("desc"), F.col("author_name").alias("author"),
            "author_id", F.unix_timestamp("created_at").alias("createTime"),
            F.struct(F.col("likes_count").alias("diggCount"), F.col("shares_count").alias("shareCount"),
                     F.col("comments_count").alias("commentCount"),
                     F.col("views_count").alias("playCount")).alias("stats"),
            F.transform(named, lambda t: F.struct(t["name"].alias("title"))).alias("challenges"),
            F.col("is_sponsored").alias("isAd"),
            F.struct(words[1].alias("musicName"), words[2].alias("musicAuthor")).alias("music"),
            F.col("likes_count").cast("int").alias("duration"), F.lit("720p").alias("definition"))
    elif platform == "truth_social":
        written = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        source = F.struct(
            F.col("post_id").alias("id"), F.col("content").alias("content_cleaned"),
            F.struct(F.col("author_name").alias("acct"), F.col("author_id").alias("id")).alias("account"),
            F.when(F.col("likes_count") % 97 == 0, "yesterday").otherwise(written).alias("created_at"),
            F.col("likes_count").alias("favourites_count"), F.col("shares_count").alias("reblogs_count"),
            F.col("comments_count").alias("replies_count"), named.alias("tags"),
            F.col("is_sponsored").alias("sponsored"),
            F.struct(words[1].alias("title"), F.concat(F.lit("https://card.example/"), "post_id").alias("url"),
                     F.lit("https://provider.example").alias("provider_url")).alias("card"))
    else:
        source = F.struct(
            F.col("post_id").alias("id"), F.col("content").alias("text"), F.col("author_name").alias("author"),
            F.col("author_id").alias("from_id"), F.unix_timestamp("created_at").alias("date"),
            F.struct(F.col("likes_count").alias("count")).alias("likes"),
            F.struct(F.col("shares_count").alias("count")).alias("reposts"),
            F.struct(F.col("comments_count").alias("count")).alias("comments"),
            "marked_as_ads", F.struct(F.lit("api").alias("type")).alias("post_source"))
    hit = F.struct("post_id", source.alias("_source"))
    return posts.select(F.to_json(F.struct(F.struct(F.array(hit).alias("hits")).alias("hits"))).alias("value"))


def _parsed(spark: SparkSession, folder: str, platform: str, **options) -> DataFrame:
    parsed = post_source.parse_envelopes(envelopes(spark, folder, platform), platform)
    return normalize.normalize(post_source.unnest_hits(parsed), platform, **options)


def _common(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "Platform", "post_id", "content", "author_name", "author_id", second("created_at"), "likes_count",
        "shares_count", "comments_count", joined("hashtags"), "is_sponsored", "total_engagement", *more)


@query
def normalize_tiktok(spark, folder):
    return _common(_parsed(spark, folder, "tiktok_video"),
                   "views_count", "music_name", "music_author", "duration", "video_quality")


@query
def normalize_truth_social(spark, folder):
    return _common(_parsed(spark, folder, "truth_social"), "provider_title", "provider_url", "provider_name")


@query
def normalize_vk(spark, folder):
    return _common(_parsed(spark, folder, "vk"), "marked_as_ads", "post_source.type", "views_count")


@query
def posts_union(spark, folder):
    platforms = ("tiktok_video", "truth_social", "vk")
    return _common(normalize.union_posts(*(_parsed(spark, folder, p) for p in platforms)),
                   "marked_as_ads", "views_count")


@query
def vk_ads_as_sponsored(spark, folder):
    return _parsed(spark, folder, "vk", vk_ads_as_sponsored=True).select("post_id", "is_sponsored", "marked_as_ads")


@query
def hashtags_from_text(spark, folder):
    found = fx.posts(spark, folder).withColumn("hashtags", tags.text_tags(F.col("content")))
    return found.select("post_id", joined("hashtags"))


@query
def total_engagement(spark, folder):
    total = normalize.total_engagement(F.col("likes_count"), F.col("shares_count"), F.col("comments_count"))
    return fx.posts(spark, folder).select("post_id", total.alias("engagement"))


@query
def post_documents(spark, folder):
    posts = fx.posts(spark, folder).select("Platform", "post_id", "author_id", "created_at", "likes_count")
    return to_documents(posts, keep_nulls=False)


@query
def dedup_events(spark, folder):
    first = fx.news(spark, folder).withColumn("ProcessedDate", F.lit("2024-02-01").cast("timestamp"))
    again = first.withColumn("NumMentions", F.col("NumMentions") + 1).withColumn(
        "ProcessedDate", F.lit("2024-02-02").cast("timestamp"))
    return dedup.dedup_events(first.unionByName(again)).select("GlobalEventID", "SQLDATE", "NumMentions", "SOURCEURL")


@query
def dedup_posts(spark, folder):
    first = fx.posts(spark, folder).withColumn("lastseents", F.lit("2024-02-01T00:00:00"))
    again = first.withColumn("likes_count", F.col("likes_count") + 1).withColumn(
        "lastseents", F.lit("2024-02-02T00:00:00"))
    return dedup.dedup_posts(again.unionByName(first)).select("Platform", "post_id", "author_id", "likes_count")


@query
def post_hit_counts(spark, folder):
    """The announced total is the share count, against the one hit each result holds."""
    posts = fx.posts(spark, folder)
    hit = F.struct(F.struct(F.col("post_id").alias("id")).alias("_source"))
    hits = F.struct(F.struct(F.col("shares_count").alias("value")).alias("total"), F.array(hit).alias("hits"))
    texts = posts.select(F.to_json(F.struct(hits.alias("hits"))).alias("value"), F.col("post_id").alias("file_name"))
    return post_source.hit_counts(post_source.parse_envelopes(texts, "tiktok_video", keep=["file_name"]))


@query
def daily_file_plan(spark, folder):
    bounds = fx.table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return manifest.daily_file_plan(bounds).select("o_orderstatus", day("day"), "file_name")


@query
def missing_daily_files(spark, folder):
    orders = fx.table(spark, folder, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    present = orders.select(F.date_format("o_orderdate", "yyyyMMdd'.export.CSV'").alias("file_name")).distinct()
    return manifest.missing_files(manifest.daily_file_plan(bounds), present).select("file_name", day("day"))


@query
def window_file_plan(spark, folder):
    bounds = fx.posts(spark, folder).groupBy("Platform").agg(
        F.min("created_at").alias("start"), F.max("created_at").alias("end"))
    return manifest.window_file_plan(bounds).select(
        "Platform", second("window_start"), second("window_end"), "file_name")


# Keywords and search ----------------------------------------------------------------------

@query
def url_path_segments(spark, folder):
    return fx.news(spark, folder).select(
        "GlobalEventID", F.array_join(urls.path_segments(F.col("SOURCEURL")), "|").alias("segments"),
        F.array_join(urls.title_candidates(F.col("SOURCEURL")), "|").alias("titles"))


@query
def url_title_segment(spark, folder):
    title = keywords.title_segment(F.col("SOURCEURL"), fx.STOP_WORDS)
    return fx.news(spark, folder).select("GlobalEventID", title.alias("title"))


@query
def url_keywords(spark, folder):
    found = keywords.extract_keywords(fx.news(spark, folder).select("GlobalEventID", "SOURCEURL"), **WORDS)
    return found.select("GlobalEventID", joined("Keywords"))


@query
def url_keywords_lexicon(spark, folder):
    found = keywords.extract_keywords(
        fx.news(spark, folder).select("GlobalEventID", "SOURCEURL"), lexicon=fx.lexicon(spark, folder), **WORDS)
    return found.select("GlobalEventID", joined("Keywords"))


@query
def page_url_keywords(spark, folder):
    pages = fx.table(spark, folder, "pages").select("page_id", "url")
    return keywords.extract_keywords(pages, "url", **WORDS).select("page_id", joined("Keywords"))


@query
def keyword_ranking_all_urls(spark, folder):
    return keywords.rank_url_keywords(fx.news(spark, folder).select("GlobalEventID", "SOURCEURL"), **WORDS)


@query
def search_term(spark, folder):
    return keywords.search_term(news.top_mentions_keywords(fx.news(spark, folder), **WORDS)).select("term")


def hashtag_ranking(posts: DataFrame) -> DataFrame:
    return keywords.rank_keywords(posts.select(tags.text_tags(F.col("content"), strip_hash=True).alias("Keywords")))


@query
def search_posts(spark, folder):
    posts = fx.posts(spark, folder)
    found = search.search_posts(posts, keywords.search_term(hashtag_ranking(posts)), *MONTH)
    return found.select("Platform", "post_id", "content", second("window_start"))


@query
def search_posts_uncapped(spark, folder):
    found = search.search_posts(fx.posts(spark, folder), None, *MONTH)
    return found.select("Platform", "post_id", second("created_at"), second("window_start"))


@query
def hashtags_from_documents(spark, folder):
    docs = fx.table(spark, folder, "documents")
    found = F.array_sort(tags.text_tags(F.col("text"), strip_hash=True))
    return docs.select("doc_id", F.array_join(found, "|").alias("hashtags"))


@query
def search_posts_capped(spark, folder):
    found = search.search_posts(fx.posts(spark, folder), None, *MONTH, limit=CAP)
    return found.select("Platform", "post_id", second("created_at"), second("window_start"))


# Cubes by day ------------------------------------------------------------------------------

def _dated(spark: SparkSession, folder: str) -> DataFrame:
    return event_source.with_event_date(fx.news(spark, folder)).where(F.col("event_date").isNotNull())


@query
def insights_from_news_days(spark, folder):
    days = cubes.news_days(event_source.with_event_date(fx.news_without_urls(spark, folder)))
    return news.insights_of(cubes.rollup_of(days)).select(day(), rounded("AvgImpact"), rounded("AvgTone"), "NumMentions")


@query
def geo_from_place_days(spark, folder):
    return cubes.geo_analysis_of(cubes.place_days(_dated(spark, folder))).select(
        "ActionGeo_Lat", "ActionGeo_Long", rounded("AvgImpact"), "NumMentions", "EventCode", "SOURCEURL", day())


@query
def serve_geo_days_in_range(spark, folder):
    return serving.serve_geo(None, *RANGE, days=cubes.place_days(_dated(spark, folder))).select(
        "ActionGeo_Lat", "ActionGeo_Long", rounded("AvgImpact"), "NumMentions", "EventCode", "SOURCEURL", "Date")


@query
def top_mentions_from_days(spark, folder):
    top = news.top_events(cubes.top_event_days(_dated(spark, folder), 20), 10)
    return news.top_mentions_of(keywords.extract_keywords(top, "SourceURL", **WORDS)).select(
        "SourceURL", "EventRootCode", day(), "TotalMentions", "Location.Latitude", "Location.Longitude",
        "NumMentions", "NumSources", "NumArticles", joined("Keywords"))


@query
def metrics_from_author_days(spark, folder):
    rollup = cubes.social_rollup_of(cubes.author_days(fx.posts(spark, folder)))
    return social.metrics_of(rollup).select(day("date"), "metrics.*").select(
        "date", "posts", "engagement", "likes", "shares", "comments", "views", "uniqueAuthors", rounded("sponsoredPercentage"))


@query
def top_authors_from_author_days(spark, folder):
    posts = fx.posts(spark, folder)
    return cubes.top_authors_of(cubes.author_days(posts), posts).select("author", "engagement", second("Date"))


# More on sparse results --------------------------------------------------------------------

@query
def events_routed(spark, folder):
    parsed = event_source.parse_event_lines(event_lines(spark, folder), keep_corrupt=True)
    return event_source.routed(parsed).select("kind", "GlobalEventID", F.col("reject_reason").alias("reason"))


@query
def serve_top_authors_first_hours(spark, folder):
    return serving.serve_top_authors(social.top_authors_engagement(fx.posts(spark, folder)), *FIRST_HOURS)


@query
def serve_top_authors_by_platform(spark, folder):
    return serving.serve_top_authors(None, *RANGE, posts=fx.posts(spark, folder), by_platform=True)


@query
def panel_top_authors_first_hours(spark, folder):
    return serving.panel(
        serving.serve_top_authors(social.top_authors_engagement(fx.posts(spark, folder)), *FIRST_HOURS), "top_authors")


@query
def document_url_keywords(spark, folder):
    return keywords.extract_keywords(fx.articles(spark, folder), "url", **WORDS).select("doc_id", joined("Keywords"))


@query
def hashtags_from_tagged_documents(spark, folder):
    found = F.array_sort(tags.text_tags(F.col("tagged"), strip_hash=True))
    return fx.articles(spark, folder).select("doc_id", F.array_join(found, "|").alias("hashtags"))
