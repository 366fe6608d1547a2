"""Platform posts to one common post relation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import dates, tags
from tidewatch.schemas import PLATFORMS

POST_COLUMNS = """
    Platform post_id content author_name author_id created_at likes_count shares_count comments_count
    hashtags datatype lastseents ProcessedDate ProcessingDate collected_by is_sponsored views_count
    music_name music_author duration video_quality provider_name provider_url provider_title
    provider_description total_engagement
""".split()

_ABSENT = {
    "views_count": "long", "music_name": "string", "music_author": "string", "duration": "int",
    "video_quality": "string", "provider_name": "string", "provider_url": "string",
    "provider_title": "string", "provider_description": "string",
}


def total_engagement(likes: Column, shares: Column, comments: Column) -> Column:
    """Likes, shares and comments with missing ones as 0; views do not count."""
    return sum((F.coalesce(c, F.lit(0)) for c in (shares, comments)), F.coalesce(likes, F.lit(0))).cast("long")


# Columns of the load, not of the source, that go along.
_CARRIED = ("load",)


def _common(df: DataFrame, platform: str, columns: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    """The common columns in their fixed order, then what only this platform has."""
    columns = columns | {
        "Platform": F.lit(platform),
        "datatype": F.col("datatype"),
        "lastseents": F.col("lastseents"),
        "collected_by": F.col("collected_by"),
        "ProcessedDate": F.current_timestamp(),
        "ProcessingDate": F.current_date(),
        "total_engagement": total_engagement(
            columns["likes_count"], columns["shares_count"], columns["comments_count"]
        ),
    }
    for name, kind in _ABSENT.items():
        columns.setdefault(name, F.lit(None).cast(kind))
    ordered = [columns[name].alias(name) for name in POST_COLUMNS]
    carried = [name for name in _CARRIED if name in df.columns]
    return df.select(*ordered, *(column.alias(name) for name, column in extra.items()), *carried)


def normalize_tiktok(df: DataFrame, *, null_tags_as_empty: bool = False) -> DataFrame:
    return _common(df, "tiktok_video", {
        "post_id": F.col("id"),
        "content": F.col("desc"),
        "author_name": F.col("author"),
        "author_id": F.col("author_id"),
        "created_at": dates.from_epoch(F.col("createTime")),
        "likes_count": F.col("stats.diggCount"),
        "shares_count": F.col("stats.shareCount"),
        "comments_count": F.col("stats.commentCount"),
        "views_count": F.col("stats.playCount"),
        "hashtags": tags.named_tags(F.col("challenges.title"), null_as_empty=null_tags_as_empty),
        "is_sponsored": F.col("isAd"),
        "music_name": F.col("music.musicName"),
        "music_author": F.col("music.musicAuthor"),
        "duration": F.col("duration"),
        "video_quality": F.col("definition"),
    }, {})


def normalize_truth_social(df: DataFrame, *, null_tags_as_empty: bool = False) -> DataFrame:
    """``provider_url`` is the link of the card itself, not the address of its provider."""
    return _common(df, "truth_social", {
        "post_id": F.col("id"),
        "content": F.col("content_cleaned"),
        "author_name": F.col("account.acct"),
        "author_id": F.col("account.id"),
        "created_at": F.try_to_timestamp("created_at"),
        "likes_count": F.col("favourites_count"),
        "shares_count": F.col("reblogs_count"),
        "comments_count": F.col("replies_count"),
        "hashtags": tags.named_tags(F.col("tags.name"), null_as_empty=null_tags_as_empty),
        "is_sponsored": F.col("sponsored"),
        "provider_name": F.col("card.provider_name"),
        "provider_url": F.col("card.url"),
        "provider_title": F.col("card.title"),
        "provider_description": F.col("card.description"),
    }, {})


def normalize_vk(df: DataFrame, *, vk_ads_as_sponsored: bool = False, strip_hash: bool = False) -> DataFrame:
    """The platform's ad flag is a number, which never equals true, so by default it does
    not make a post sponsored; the number itself is kept as ``marked_as_ads``."""
    sponsored = F.col("marked_as_ads") == 1 if vk_ads_as_sponsored else F.lit(None).cast("boolean")
    return _common(df, "vk", {
        "post_id": F.col("id"),
        "content": F.col("text"),
        "author_name": F.col("author"),
        "author_id": F.col("from_id"),
        "created_at": dates.from_epoch(F.col("date")),
        "likes_count": F.col("likes.count"),
        "shares_count": F.col("reposts.count"),
        "comments_count": F.col("comments.count"),
        "views_count": F.col("views.count"),
        "hashtags": tags.text_tags(F.col("text"), strip_hash=strip_hash),
        "is_sponsored": sponsored,
    }, {"post_source": F.col("post_source"), "marked_as_ads": F.col("marked_as_ads")})


NORMALIZERS = {
    "truth_social": normalize_truth_social,
    "tiktok_video": normalize_tiktok,
    "vk": normalize_vk,
}


def normalize(df: DataFrame, platform: str, **options) -> DataFrame:
    """Source documents of one platform as common posts."""
    platform = platform.lower()
    if platform not in NORMALIZERS:
        raise ValueError(f"unknown platform {platform!r}; supported: {', '.join(PLATFORMS)}")
    return NORMALIZERS[platform](df, **options)


def union_posts(*posts: DataFrame) -> DataFrame:
    """All platforms as one relation; a column only one platform has is null elsewhere."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), posts)
