"""Hand-written events and posts with defaults for what a test does not name."""

import datetime as dt

EVENT_FIELDS = """GlobalEventID int, SQLDATE string, GoldsteinScale double, AvgTone double, NumMentions int,
    NumSources int, NumArticles int, EventCode string, EventRootCode string, ActionGeo_Lat double,
    ActionGeo_Long double, SOURCEURL string"""
POST_FIELDS = """Platform string, post_id string, content string, author_name string, author_id string,
    created_at timestamp, likes_count long, shares_count long, comments_count long, views_count long,
    is_sponsored boolean, total_engagement long"""

EVENT = dict(GlobalEventID=1, SQLDATE="20240105", GoldsteinScale=1.0, AvgTone=2.0, NumMentions=3, NumSources=2,
             NumArticles=1, EventCode="010", EventRootCode="01", ActionGeo_Lat=1.5, ActionGeo_Long=2.5,
             SOURCEURL="https://x.org/one")
POST = dict(Platform="vk", post_id="p1", content="hello", author_name="Ann", author_id="a1",
            created_at=dt.datetime(2024, 1, 5, 10), likes_count=1, shares_count=2, comments_count=3,
            views_count=None, is_sponsored=None, total_engagement=6)


def _frame(spark, default, fields, rows):
    return spark.createDataFrame([tuple({**default, **row}.values()) for row in rows], fields)


def events(spark, *rows):
    return _frame(spark, EVENT, EVENT_FIELDS, rows)


def posts(spark, *rows):
    return _frame(spark, POST, POST_FIELDS, rows)


def at(text):
    return dt.datetime.fromisoformat(text)
