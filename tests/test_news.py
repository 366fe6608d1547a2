import datetime as dt

from pyspark.sql import functions as F
from samples import events

from tidewatch.operators import news
from tidewatch.sources.events import with_event_date

D5, D6 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def test_daily_insights_skip_nulls_and_count_events(spark):
    frame = events(
        spark,
        dict(GlobalEventID=1, GoldsteinScale=4.0, NumMentions=100),
        dict(GlobalEventID=2, GoldsteinScale=None, NumMentions=100),
        dict(GlobalEventID=3, SQLDATE="20240106", GoldsteinScale=None),
        dict(GlobalEventID=4, SQLDATE="20240199"), dict(GlobalEventID=5, SQLDATE=None),
        dict(GlobalEventID=6, SQLDATE="--"),
    )
    rows = [tuple(r) for r in news.daily_insights(frame).collect()]
    assert rows == [(D5, 4.0, 2.0, 2), (D6, None, 2.0, 1)]


def test_text_after_the_day_is_ignored_and_merges_with_it(spark):
    frame = events(spark, dict(SQLDATE="20240105"), dict(SQLDATE="20240105T10"))
    assert [tuple(r) for r in news.trend_analysis(frame).collect()] == [(D5, 6)]


def test_trend_sums_the_column_and_gives_zero_for_an_all_null_day(spark):
    frame = events(
        spark, dict(NumMentions=3), dict(NumMentions=None), dict(NumMentions=4),
        dict(SQLDATE="20240106", NumMentions=None),
    )
    assert [tuple(r) for r in news.trend_analysis(frame).collect()] == [(D5, 7), (D6, 0)]


def test_sums_do_not_overflow_int(spark):
    frame = events(spark, *[dict(GlobalEventID=i, NumMentions=2_000_000_000, NumSources=2_000_000_000)
                            for i in range(3)])
    assert news.trend_analysis(frame).first()["NumMentions"] == 6_000_000_000
    assert news.top_mentions(frame, stop_words=[]).first()["TotalMentions"] == 4_000_000_001


def test_an_ingested_table_groups_by_its_typed_day(spark):
    frame = events(spark, dict(NumMentions=3), dict(SQLDATE="20240106"), dict(SQLDATE="bad"))
    typed = with_event_date(frame).drop("SQLDATE")
    assert [tuple(r) for r in news.trend_analysis(typed).collect()] == [(D5, 3), (D6, 3)]
    assert [r["Date"] for r in news.geo_analysis(typed.limit(1)).collect()] == [D5]


def test_places_merge_signed_zero_keep_origin_and_drop_nulls(spark):
    frame = events(
        spark,
        dict(GlobalEventID=9, ActionGeo_Lat=-0.0, ActionGeo_Long=0.0, EventCode="late", SOURCEURL=None,
             SQLDATE="20240106"),
        dict(GlobalEventID=3, ActionGeo_Lat=0.0, ActionGeo_Long=0.0, EventCode=None, SOURCEURL="first"),
        dict(GlobalEventID=None, ActionGeo_Lat=0.0, ActionGeo_Long=0.0, EventCode="unnumbered"),
        dict(GlobalEventID=4, ActionGeo_Lat=None), dict(GlobalEventID=5, ActionGeo_Long=None),
        dict(GlobalEventID=6),
    )
    rows = [tuple(r) for r in news.geo_analysis(frame).collect()]
    # The representative is one event as a whole, nulls included.
    assert rows == [(0.0, 0.0, 1.0, 3, None, "first", D5), (1.5, 2.5, 1.0, 1, "010", "https://x.org/one", D5)]


def test_top_mentions_order_ties_and_null_totals(spark):
    frame = events(
        spark,
        dict(GlobalEventID=7, NumMentions=10), dict(GlobalEventID=2, NumMentions=10),
        dict(GlobalEventID=1, NumArticles=None, NumMentions=999), dict(GlobalEventID=3, NumMentions=11,
                                                                      SOURCEURL=None, SQLDATE="nope"),
    )
    rows = news.top_mentions(frame, stop_words=[]).collect()
    assert [r["TotalMentions"] for r in rows] == [14, 13, 13, None]
    assert rows[0]["Date"] is None and rows[0]["Keywords"] == []
    assert rows[1]["Date"] == dt.datetime(2024, 1, 5)
    assert rows[1]["Location"].asDict() == {"Latitude": 1.5, "Longitude": 2.5}
    assert len(news.top_mentions(frame, n=2, stop_words=[]).collect()) == 2


def test_keyword_ranking_counts_repeated_urls_and_keeps_first_appearance(spark):
    frame = events(
        spark,
        dict(GlobalEventID=1, NumMentions=50, SOURCEURL="https://x.org/zebra-market"),
        dict(GlobalEventID=2, NumMentions=40, SOURCEURL="https://x.org/market-apple"),
        dict(GlobalEventID=3, NumMentions=40, SOURCEURL="https://x.org/market-apple"),
        dict(GlobalEventID=4, NumMentions=1, SOURCEURL="https://x.org/hidden-story"),
    )
    ranked = news.top_mentions_keywords(frame, n=3, stop_words=[]).collect()
    assert [(r["keyword"], r["n"]) for r in ranked] == [("market", 3), ("apple", 2), ("zebra", 1)]


def test_equal_ids_and_no_ids_leave_one_row_per_place(spark):
    """A load that came twice, an id used twice, and places whose events have no id at all."""
    rows = [dict(GlobalEventID=5, EventCode="020", SOURCEURL="b"), dict(GlobalEventID=5, EventCode="010", SOURCEURL="z"),
            dict(GlobalEventID=5, EventCode="010", SOURCEURL="c"), dict(GlobalEventID=None, EventCode="001"),
            dict(GlobalEventID=7, EventCode="000")]
    rows += [dict(GlobalEventID=None, EventCode=c, ActionGeo_Lat=0.0, SOURCEURL=u) for c, u in (("030", "q"), ("030", None), ("040", "a"))]
    rows += [dict(GlobalEventID=9, ActionGeo_Lat=-0.0, EventCode="050"), dict(ActionGeo_Lat=None), dict(ActionGeo_Long=float("nan"))]
    frame = events(spark, *rows)
    for twice in (frame, frame.unionByName(frame)):
        found = {(r.ActionGeo_Lat, str(r.ActionGeo_Long)): (r.EventCode, r.SOURCEURL) for r in news.geo_analysis(twice).collect()}
        assert found == {(1.5, "2.5"): ("010", "c"), (0.0, "2.5"): ("050", "https://x.org/one"), (1.5, "nan"): ("010", "https://x.org/one")}
        assert news.geo_analysis(twice).count() == 3
    lost = frame.where("GlobalEventID is null")
    assert [(r.EventCode, r.SOURCEURL) for r in news.geo_analysis(lost.where("ActionGeo_Lat = 0")).collect()] == [("030", None)]


def test_a_crowd_without_ids_at_one_place_sends_a_row_per_task(spark):
    crowd = events(spark, dict(GlobalEventID=None)).crossJoin(spark.range(0, 30000, 1, 8)).withColumn(
        "SOURCEURL", F.lpad(F.col("id").cast("string"), 6, "0"))
    found = news.geo_analysis(crowd)
    assert [(r.NumMentions, r.SOURCEURL) for r in found.collect()] == [(30000, "000000")]
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
