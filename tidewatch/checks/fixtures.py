"""News events and posts derived from the driver tables.

Every column is one expression that both engines read the same way, so the DataFrame and
the SQL text of a view cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import CORE_CONF

STOP_WORDS = "a an and at by for from in of on or the to with".split()

# One event per order; its part names the article.
NEWS = {
    "GlobalEventID": "o_orderkey",
    "SQLDATE": "'202401' || lpad(cast(1 + o_orderkey % 31 as varchar(2)), 2, '0')",
    "GoldsteinScale": "case when o_orderkey % 97 = 0 then null "
                      "else cast((o_orderkey * 7) % 201 - 100 as double) / 10 end",
    "AvgTone": "cast((o_orderkey * 13) % 401 - 200 as double) / 20",
    "NumMentions": "cast(o_orderkey % 50 as int)",
    "NumSources": "cast(o_orderkey % 7 as int)",
    "NumArticles": "case when o_orderkey % 101 = 0 then null else cast(o_orderkey % 50 as int) end",
    "EventCode": "cast(100 + o_custkey % 100 as varchar(3))",
    "EventRootCode": "substring(cast(100 + o_custkey % 100 as varchar(3)), 1, 2)",
    "ActionGeo_Lat": "case when o_orderkey % 53 = 0 then null else cast(o_custkey % 181 - 90 as double) end",
    "ActionGeo_Long": "cast(o_custkey % 361 - 180 as double)",
    "SOURCEURL": """case
        when o_orderkey % 59 = 0 then null
        when o_orderkey % 4 = 0 then 'https://news.example.org/world/' || cast(o_orderkey as varchar(20)) || '/'
            || replace(p_name, ' ', '-') || '-' || p_type || '.html'
        when o_orderkey % 4 = 1 then 'http://www.example.com/api/v2/' || replace(p_name, ' ', '_')
            || '-sales-hit-the-' || lower(p_type) || '-market?id=' || cast(o_orderkey as varchar(20))
        when o_orderkey % 4 = 2 then '//example.net/biz/' || replace(p_name, ' ', '%20') || '%2Ftwo-'
            || replace(p_brand, '#', '%23') || '-plants-and-' || p_type || ';ref=' || cast(o_orderkey as varchar(20)) || '#top'
        else 'example.org/2024/01/15/world-news/' || replace(p_name, ' ', '--') || '/'
            || cast(o_orderkey as varchar(20)) end""",
}

# One post per event of the stream table.
POSTS = {
    "Platform": "case when event_type in ('view', 'signup') then 'tiktok_video' "
                "when event_type = 'purchase' then 'vk' else 'truth_social' end",
    "post_id": "cast(event_id as varchar(20))",
    "content": "'note ' || event_type || ' #tag' || cast(user_id % 7 as varchar(20)) || ' #' || event_type "
               "|| ' #tag' || cast(user_id % 7 as varchar(20))",
    "author_name": "'user_' || cast(user_id as varchar(20))",
    "author_id": "case when event_id % 89 = 0 then null else cast(user_id as varchar(20)) end",
    "created_at": "case when event_id % 83 = 0 then null else cast(ts as timestamp) end",
    "likes_count": "cast(floor(value) as bigint)",
    "shares_count": "cast(regexp_extract(props, '[0-9]+', 0) as bigint)",
    "comments_count": "case when event_id % 11 = 0 then null else event_id % 10 end",
    "views_count": "case when event_type in ('view', 'signup') then (event_id * 3) % 1000 end",
    "is_sponsored": "case when event_type = 'purchase' then null else event_id % 10 = 0 end",
    "marked_as_ads": "case when event_type = 'purchase' then cast(event_id % 2 as int) end",
    "total_engagement": "cast(floor(value) as bigint) + cast(regexp_extract(props, '[0-9]+', 0) as bigint) "
                        "+ coalesce(case when event_id % 11 = 0 then null else event_id % 10 end, 0)",
}

ARTICLES = {
    "url": "'https://docs.example.org/' || lang || '/' || replace(translate(substring(text, 1, 70), "
           "'#%?;&/:+' || chr(10) || chr(13) || chr(9), ''), ' ', '-') || '.html'",
    "tagged": "replace(replace(text, ' a', ' #a'), ' e', ' #e')",
}

# Part of speech of the words the part names are made of.
LEXICON = """
    select distinct lower(split_part(p_name, ' ', 1)) as token, 'ADJ' as pos,
           lower(split_part(p_name, ' ', 1)) as lemma from part
    union
    select distinct lower(split_part(p_name, ' ', 2)),
           case when length(split_part(p_name, ' ', 2)) = 4 then 'VERB' else 'NOUN' end,
           lower(split_part(p_name, ' ', 2)) || 's' from part
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, CORE_CONF[key])
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in expressions.items()]


def news(spark: SparkSession, folder: str) -> DataFrame:
    orders, parts = table(spark, folder, "orders"), table(spark, folder, "part")
    article = F.col("o_orderkey") % parts.select(F.count(F.lit(1))).scalar()
    joined = orders.withColumn("article", article).join(parts, F.col("article") == F.col("p_partkey"), "left")
    return joined.selectExpr(*_columns(NEWS))


def news_without_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The same events for operators that read no URL, which then need no part."""
    return table(spark, folder, "orders").selectExpr(*_columns({k: v for k, v in NEWS.items() if k != "SOURCEURL"}))


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an address made of their first words, and with some of their words as hashtags."""
    return table(spark, folder, "documents").selectExpr("doc_id", *_columns(ARTICLES))


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*_columns(POSTS))


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(LEXICON.replace("from part", "from {part}"), part=table(spark, folder, "part"))


NEWS_SQL = (
    f"select {', '.join(_columns(NEWS))} from orders "
    "left join part on p_partkey = o_orderkey % (select count(*) from part)"
)
ARTICLES_SQL = f"select doc_id, {', '.join(_columns(ARTICLES))} from documents"
POSTS_SQL = f"select {', '.join(_columns(POSTS))} from events"
