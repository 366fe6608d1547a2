import datetime as dt

import pytest
from samples import at, events, posts

from tidewatch.functions.dates import relative_range
from tidewatch.operators import news, serving, social


@pytest.fixture(scope="module")
def days(spark):
    rows = [(dt.date(2024, 1, d), d) for d in range(1, 8)]
    return spark.createDataFrame(rows, "Date date, NumMentions long")


@pytest.mark.parametrize("start, end, expected", [
    ("2024-01-03T00:00:00.000Z", "2024-01-05T00:00:00.000Z", [3, 4, 5]),
    ("2024-01-03T00:00:00.001Z", "2024-01-05T23:59:59.000Z", [4, 5]),
    ("2024-01-03T01:00:00+02:00", "2024-01-04T23:00:00-02:00", [3, 4, 5]),
    (dt.date(2024, 1, 6), dt.datetime(2024, 1, 6), [6]),
    ("2024-01-03T00:00:00Z", None, list(range(1, 8))),
    (None, "2024-01-03T00:00:00Z", list(range(1, 8))),
    (None, None, list(range(1, 8))),
])
def test_daily_range_is_inclusive_and_needs_both_bounds(days, start, end, expected):
    rows = serving.serve_trend(days, start, end).collect()
    assert [r["NumMentions"] for r in rows] == expected
    assert rows[0]["Date"] == f"2024-01-0{expected[0]}T00:00:00.000Z"


def test_live_range_excludes_its_start_and_includes_its_end(spark):
    frame = posts(
        spark,
        dict(created_at=at("2024-01-05T10:00:00"), likes_count=1, shares_count=0, comments_count=0),
        dict(created_at=at("2024-01-06T10:00:00"), likes_count=0, shares_count=1, comments_count=0),
        dict(created_at=None, likes_count=0, shares_count=0, comments_count=2),
    )
    inside = serving.serve_platform_distribution(frame, "2024-01-05T10:00:00Z", "2024-01-06T10:00:00Z").first()
    assert tuple(inside)[1:] == (0.0, 100.0, 0.0)
    assert tuple(serving.serve_platform_distribution(frame).first())[1:] == (25.0, 25.0, 50.0)


def test_geo_range_looks_at_the_representative_day_or_at_the_events(spark):
    frame = events(
        spark, dict(GlobalEventID=1, SQLDATE="20240101"), dict(GlobalEventID=2, SQLDATE="20240105"),
        dict(GlobalEventID=3, SQLDATE="20240105"),
    )
    span = ("2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z")
    assert serving.serve_geo(news.geo_analysis(frame), *span).collect() == []
    (row,) = serving.serve_geo(None, *span, events=frame).collect()
    assert (row["NumMentions"], row["Date"]) == (2, "2024-01-05T00:00:00.000Z")


def test_geo_keeps_the_fifty_busiest_places(spark):
    rows = [dict(GlobalEventID=i, ActionGeo_Lat=float(i % 60)) for i in range(90)]
    served = serving.serve_geo(news.geo_analysis(events(spark, *rows))).collect()
    assert [r["NumMentions"] for r in served] == [2] * 30 + [1] * 20


def test_author_range_applies_after_the_cut_or_before_counting(spark):
    frame = posts(
        spark,
        dict(author_id="a", author_name="A", total_engagement=9, created_at=at("2024-01-01T00:00:00")),
        dict(author_id="a", author_name="A", total_engagement=1, created_at=at("2024-01-05T00:00:00.250")),
        dict(author_id="b", author_name="B", total_engagement=2, created_at=at("2024-01-05T00:00:00")),
    )
    span = ("2024-01-05T00:00:00Z", "2024-01-06T00:00:00Z")
    table = social.top_authors_engagement(frame)
    assert [tuple(r) for r in serving.serve_top_authors(table, *span).collect()] == [
        ("B", 2, "2024-01-05T00:00:00.000Z")]
    assert [tuple(r) for r in serving.serve_top_authors(None, *span, posts=frame).collect()] == [
        ("B", 2, "2024-01-05T00:00:00.000Z"), ("A", 1, "2024-01-05T00:00:00.250Z")]
    assert serving.serve_top_authors(social.top_authors_engagement(frame, 1), *span).collect() == []


def test_non_finite_numbers_become_null_at_any_depth(spark):
    frame = spark.sql("select double('NaN') a, named_struct('b', double('Infinity'), 'c', 1.5D, 'd', 'x') s")
    assert serving.finite_only(frame).first().asDict(recursive=True) == {"a": None, "s": {"b": None, "c": 1.5, "d": "x"}}


def test_social_metrics_are_served_with_text_days(spark):
    served = serving.serve_social_metrics(social.social_temporal_metrics(posts(spark, dict())))
    assert served.first()["date"] == "2024-01-05"
    assert tuple(serving.panel(served, "social_engagement").first()) == ("2024-01-05", 6)


def test_relative_range_ends_now():
    assert relative_range("2024-01-31T12:00:00Z", 7) == (dt.datetime(2024, 1, 24, 12), dt.datetime(2024, 1, 31, 12))
    assert relative_range(dt.datetime(2024, 1, 31))[0] == dt.datetime(2024, 1, 1)
