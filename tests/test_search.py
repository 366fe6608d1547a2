import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from samples import at, posts

from tidewatch.operators import keywords, search

SPAN = ("2024-01-01", "2024-01-31")


def ids(frame):
    return sorted(r["post_id"] for r in frame.collect())


@pytest.mark.parametrize("terms, expected", [
    (["storm"], ["1", "2", "5"]), (["STORM", "flood"], ["1", "2", "3", "5"]), (["a.b"], ["4"]), (["été"], ["6"]),
    ([], ["1", "2", "3", "4", "5", "6", "7", "8"]), (None, ["1", "2", "3", "4", "5", "6", "7", "8"]),
])
def test_whole_words_in_any_case(spark, terms, expected):
    texts = ["Storm ahead", "a #storm", "flood", "see a.b now", "x\nstorm,", "L'ÉTÉ vient", "brainstorms axb", None]
    frame = posts(spark, *[dict(post_id=str(i + 1), content=t) for i, t in enumerate(texts)])
    assert ids(search.search_posts(frame, terms, *SPAN)) == expected


def test_the_term_may_be_part_of_the_plan(spark):
    frame = posts(spark, dict(post_id="1", content="storm"), dict(post_id="2", content="calm"))
    ranked = spark.createDataFrame([("storm", 3)], "keyword string, n long")
    assert ids(search.search_posts(frame, keywords.search_term(ranked), *SPAN)) == ["1"]
    assert ids(search.search_posts(frame, keywords.search_term(ranked.limit(0)), *SPAN)) == ["1", "2"]


def test_range_is_half_open_and_windows_start_at_it(spark):
    moments = ["2023-12-31T23:59:59", "2024-01-01T00:00:00", "2024-01-03T23:59:59.999999", "2024-01-04T00:00:00",
               "2024-01-31T00:00:00"]
    frame = posts(spark, *[dict(post_id=str(i), created_at=at(m)) for i, m in enumerate(moments)])
    rows = {r["post_id"]: r["window_start"] for r in search.search_posts(frame, None, *SPAN).collect()}
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 4)
    assert rows == {"1": first, "2": first, "3": second}


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_cap_equals_brute_force_with_a_crowded_group_and_equal_times(spark, limit):
    random.seed(limit)
    rows = []
    for i in range(3000):
        crowded = i % 3 == 0
        rows.append(dict(
            Platform="vk" if crowded else random.choice(["vk", "truth_social", "tiktok_video"]),
            post_id=f"{i:05}",
            created_at=at("2024-01-02T00:00:00") if crowded else
            dt.datetime(2024, 1, 1) + dt.timedelta(seconds=random.randrange(86400 * 30)),
        ))
    want, seen = [], {}
    for row in sorted(rows, key=lambda r: (r["created_at"], r["post_id"])):
        group = (row["Platform"], (row["created_at"] - dt.datetime(2024, 1, 1)).days // 3)
        seen[group] = seen.get(group, 0) + 1
        if seen[group] <= limit:
            want.append(row["post_id"])
    assert ids(search.search_posts(posts(spark, *rows), None, *SPAN, limit=limit)) == sorted(want)


def test_copies_of_one_post_spread_over_slices(spark):
    frame = posts(spark, dict()).crossJoin(spark.range(0, 4000, 1, 8)).drop("id")
    sliced = search.capped(frame, ["Platform"], [F.asc("created_at"), F.asc("post_id")], 25, "post_id")
    assert sliced.count() == 25


def test_a_limit_beyond_what_spark_ranks_early(spark):
    """A cap above the threshold of the optimizer's own limit, on a group that exceeds it."""
    frame = posts(spark, dict()).crossJoin(spark.range(0, 3000, 1, 8)).withColumn("post_id", F.lpad("id", 5, "0")).drop("id")
    found = ids(search.search_posts(frame, None, *SPAN, limit=1500))
    assert found == [f"{i:05}" for i in range(1500)]
    assert search.search_posts(frame, None, *SPAN).count() == 3000


def test_a_quotation_mark_of_patterns_within_a_word(spark):
    frame = posts(spark, dict(post_id="1", content="see a\\E+b now"), dict(post_id="2", content="calm"))
    assert ids(search.search_posts(frame, ["a\\E+b"], *SPAN)) == ["1"]


def test_no_cap_needs_no_shuffle(spark):
    text = search.search_posts(posts(spark, dict()), ["storm"], *SPAN)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange" not in text
