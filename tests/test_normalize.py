import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dedup, normalize
from tidewatch.sources import posts as source


def parsed(spark, platform, *sources, **options):
    text = json.dumps({"hits": {"hits": [{"_source": s} for s in sources]}})
    frame = source.parse_envelopes(spark.createDataFrame([(text,)], "value string"), platform)
    return normalize.normalize(source.unnest_hits(frame), platform, **options)


def test_tiktok(spark):
    frame = parsed(
        spark, "tiktok_video",
        {"id": 12, "desc": "d", "author": "n", "author_id": "a", "createTime": 1704448800, "isAd": True,
         "stats": {"diggCount": 1, "shareCount": 2, "playCount": 50}, "challenges": [{"title": "x"}, {"id": "2"}],
         "music": {"musicName": "m", "musicAuthor": "ma"}, "duration": 9, "definition": "720p", "lastseents": "2024"},
        {"id": "2", "createTime": 9_000_000_000_000_000}, {"id": "3", "challenges": []},
    )
    assert frame.columns == normalize.POST_COLUMNS
    full, bare, empty = frame.collect()
    assert (full["post_id"], full["created_at"], full["total_engagement"]) == ("12", dt.datetime(2024, 1, 5, 10), 3)
    assert (full["views_count"], full["comments_count"], full["is_sponsored"]) == (50, None, True)
    assert (full["hashtags"], bare["hashtags"], empty["hashtags"]) == (["x", None], None, [])
    assert (full["music_name"], full["duration"], full["video_quality"]) == ("m", 9, "720p")
    assert (bare["created_at"], bare["total_engagement"], bare["provider_name"]) == (None, 0, None)
    as_empty = parsed(spark, "tiktok_video", {"id": "2"}, null_tags_as_empty=True).first()
    assert as_empty["hashtags"] == []


def test_truth_social(spark):
    frame = parsed(
        spark, "truth_social",
        {"id": "1", "content_cleaned": "c", "created_at": "2024-01-05T10:00:00.500Z", "favourites_count": 4,
         "account": {"id": "a", "acct": "n"}, "tags": [{"name": "t"}],
         "card": {"url": "link", "provider_url": "home", "provider_name": "p", "title": "ti", "description": "de"}},
        {"id": "2", "created_at": "yesterday"},
        {"id": "3", "created_at": "2024-01-05T10:00:00+02:00"},
    )
    one, two, three = frame.collect()
    assert one["created_at"] == dt.datetime(2024, 1, 5, 10, 0, 0, 500000) and two["created_at"] is None
    assert three["created_at"] == dt.datetime(2024, 1, 5, 8)
    assert (one["provider_url"], one["provider_name"], one["author_name"]) == ("link", "p", "n")
    assert (one["hashtags"], one["total_engagement"], one["views_count"]) == (["t"], 4, None)


def test_vk(spark):
    frame = parsed(
        spark, "vk",
        {"id": 5, "from_id": -7, "text": "a #b #b c#d #e,\n#f #G", "date": 1704448800, "marked_as_ads": 1,
         "likes": {"count": 1}, "reposts": {"count": 2}, "comments": {"count": 3}, "views": {"count": 4},
         "post_source": {"type": 8}},
        {"id": "2", "marked_as_ads": 0}, {"id": "3"},
    )
    one, two, three = frame.collect()
    assert one["hashtags"] == ["#b", "#e,\n#f", "#G"] and three["hashtags"] is None
    assert (one["post_id"], one["author_id"], one["total_engagement"], one["views_count"]) == ("5", "-7", 6, 4)
    assert (one["is_sponsored"], one["marked_as_ads"], one["post_source"]["type"]) == (None, 1, 8)
    flags = [r["is_sponsored"] for r in parsed(
        spark, "vk", {"marked_as_ads": 1}, {"marked_as_ads": 0}, {}, vk_ads_as_sponsored=True).collect()]
    assert flags == [True, False, None]
    assert parsed(spark, "vk", {"text": "#a #b"}, strip_hash=True).first()["hashtags"] == ["a", "b"]


def test_union_has_the_common_columns_and_the_vk_extras(spark):
    united = normalize.union_posts(*(parsed(spark, p, {"id": "1"}) for p in normalize.NORMALIZERS))
    assert united.columns == normalize.POST_COLUMNS + ["post_source", "marked_as_ads"]
    assert len(normalize.POST_COLUMNS) == 26 and united.count() == 3


def test_unknown_platform(spark):
    with pytest.raises(ValueError, match="myspace"):
        normalize.normalize(spark.range(1), "myspace")


def test_dedup_keeps_the_latest_copy_and_every_row_without_key(spark):
    frame = spark.createDataFrame(
        [("vk", "1", "2024-01-01", 5), ("vk", "1", "2024-01-03", 7), ("vk", "1", None, 9), ("vk", None, "x", 1),
         ("vk", None, "x", 1), ("tiktok_video", "1", "2024-01-01", 2)],
        "Platform string, post_id string, lastseents string, likes_count long")
    rows = [tuple(r) for r in dedup.dedup_posts(frame).collect()]
    assert sorted(rows, key=repr) == sorted(
        [("vk", "1", "2024-01-03", 7), ("vk", None, "x", 1), ("vk", None, "x", 1),
         ("tiktok_video", "1", "2024-01-01", 2)], key=repr)
    events = spark.range(5).select(F.lit(1).alias("GlobalEventID"), F.lit("20240105").alias("SQLDATE"))
    assert dedup.dedup_events(events).count() == 1
