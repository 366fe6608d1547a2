import datetime as dt

import pytest
from samples import at, events, posts

from tidewatch.operators import correlation, social

D5 = dt.date(2024, 1, 5)


def test_metrics_group_undated_posts_and_count_known_authors_once(spark):
    frame = posts(
        spark,
        dict(post_id="1", is_sponsored=True, views_count=10), dict(post_id="2", is_sponsored=False),
        dict(post_id="3", author_id=None, likes_count=None), dict(post_id="4", author_id="a2"),
        dict(post_id="5", created_at=None, likes_count=None, shares_count=None, comments_count=None,
             total_engagement=0),
    )
    rows = {r["date"]: r["metrics"] for r in social.social_temporal_metrics(frame).collect()}
    assert set(rows) == {None, D5}
    day = rows[D5]
    assert (day.posts, day.engagement, day.likes, day.views, day.uniqueAuthors) == (4, 24, 3, 10, 2)
    assert day.sponsoredPercentage == 25.0
    assert (rows[None].likes, rows[None].views, rows[None].sponsoredPercentage) == (0, 0, 0.0)


def test_engagement_by_day_equals_the_metrics(spark):
    frame = posts(spark, dict(), dict(created_at=at("2024-01-06T00:00:00")), dict(created_at=None))
    metrics = {r["date"]: r["metrics"].engagement for r in social.social_temporal_metrics(frame).collect()}
    daily = {r["Date"]: r["total_engagement"] for r in social.social_daily_engagement(frame).collect()}
    assert metrics == daily


def test_top_authors_merge_ids_across_platforms_unless_told_apart(spark):
    frame = posts(
        spark,
        dict(Platform="vk", author_name="Late", total_engagement=5, created_at=at("2024-01-09T00:00:00")),
        dict(Platform="tiktok_video", author_name="Early", total_engagement=6, created_at=at("2024-01-07T00:00:00")),
        dict(author_id=None, author_name="Nobody", total_engagement=8, created_at=None),
        dict(author_id=None, author_name="Someone", total_engagement=0, created_at=at("2024-01-08T00:00:00")),
        dict(author_id="b", author_name="Bo", total_engagement=8, created_at=at("2024-01-01T00:00:00")),
    )
    rows = [tuple(r) for r in social.top_authors_engagement(frame).collect()]
    assert rows == [("Early", 11, at("2024-01-07T00:00:00")), ("Bo", 8, at("2024-01-01T00:00:00")),
                    ("Someone", 8, at("2024-01-08T00:00:00"))]
    apart = [tuple(r)[:3] for r in social.top_authors_engagement(frame, by_platform=True).collect()]
    assert apart == [("vk", "Bo", 8), ("vk", "Someone", 8), ("tiktok_video", "Early", 6), ("vk", "Late", 5)]


def test_top_authors_cut_is_exact_under_ties(spark):
    frame = posts(spark, *[dict(post_id=str(i), author_id=f"a{i:02}", author_name=f"n{i:02}") for i in range(30)])
    assert [r["author"] for r in social.top_authors_engagement(frame, 4).collect()] == ["n00", "n01", "n02", "n03"]


def test_platform_shares_and_platform_without_engagement(spark):
    frame = posts(
        spark, dict(likes_count=1, shares_count=2, comments_count=None), dict(likes_count=1, shares_count=None,
                                                                           comments_count=4),
        dict(Platform="truth_social", likes_count=0, shares_count=None, comments_count=0),
    )
    quiet, busy = social.platform_engagement_distribution(frame).collect()
    assert tuple(quiet) == ("truth_social", None, None, None)
    assert tuple(busy)[1:] == (25.0, 25.0, 50.0)


def test_pairing_keeps_days_of_both_sides_only(spark):
    news = events(spark, dict(), dict(SQLDATE="20240106"), dict(SQLDATE=None))
    talk = posts(spark, dict(), dict(created_at=None), dict(created_at=at("2024-01-09T00:00:00")))
    assert [tuple(r) for r in correlation.news_social_correlation(news, talk).collect()] == [(D5, 3, 6)]


def test_upsert_replaces_produced_days_and_is_idempotent(spark):
    fields = "Date date, mentions long, engagement long"
    old = spark.createDataFrame([(D5, 1, 1), (dt.date(2024, 1, 1), 2, 2)], fields)
    new = spark.createDataFrame([(D5, 9, 9)], fields)
    once = correlation.upsert_by_date(old, new)
    twice = correlation.upsert_by_date(once, new)
    expected = [(dt.date(2024, 1, 1), 2, 2), (D5, 9, 9)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


@pytest.mark.parametrize("share", [0.34, 0.9])
def test_a_hot_author_changes_no_result(spark, share):
    size = 3000
    rows = [dict(post_id=str(i), author_id="hot" if i < size * share else f"a{i}", total_engagement=1)
            for i in range(size)]
    top = social.top_authors_engagement(posts(spark, *rows), 1).first()
    assert top["engagement"] == sum(r["author_id"] == "hot" for r in rows)
