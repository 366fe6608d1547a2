import datetime as dt
import json
import logging

import pytest
from raw import line, write_hits, write_lines
from samples import at, events, posts

from tidewatch.operators import news
from tidewatch.plans import refresh
from tidewatch.session import cut_lineage
from tidewatch.sinks import tables
from tidewatch.sources.events import read_events, with_event_date
from tidewatch.streaming import ingest


def days(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), v) for d, v in rows], "Date date, v long")


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("Date", "v").collect())


def test_append_adds_again_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = days(spark, (1, 1), (2, 2))
    assert tables.append_rows(frame, path, ["Date"], sort_by=["v"]) == 2
    assert tables.append_rows(frame, path, ["Date"], rows_per_file=1) == 2
    assert len(read(spark, path)) == 4


def test_replacing_partitions_twice_equals_once_and_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(days(spark, (1, 1), (2, 2)), path, ["Date"])
    for _ in range(2):
        assert tables.replace_partitions(days(spark, (2, 9)), path, ["Date"]) == 1
    assert read(spark, path) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 9)]


def test_replace_table_and_empty_result(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(days(spark, (1, 1)), path, sort_by=["v"])
    empty = days(spark, (1, 1)).where("v > 5")
    assert tables.write_status("t", lambda: tables.replace_table(empty, path)) == ("t", 0, False, None)
    assert tables.write_status("t", lambda: tables.replace_table(empty, path), empty_ok=True).ok
    assert read(spark, path) == []


def test_a_failing_write_is_a_status(spark, tmp_path):
    broken = days(spark, (1, 0)).selectExpr("Date", "1 / v as v")
    status = tables.write_status("t", lambda: tables.replace_table(broken, str(tmp_path / "t")))
    assert not status.ok and "DIVIDE_BY_ZERO" in status.error
    assert tables.status_frame(spark, [status]).first()["ok"] is False


def test_documents_keep_or_drop_nulls_and_write_iso_times(spark):
    frame = posts(spark, dict(created_at=at("2024-01-05T10:00:00")), dict(created_at=at("2024-01-05T10:00:00.25")))
    frame = frame.select("post_id", "author_id", "created_at", "views_count")
    kept = [json.loads(r[0]) for r in tables.to_documents(frame, keep_nulls=True).collect()]
    dropped = [json.loads(r[0]) for r in tables.to_documents(frame, keep_nulls=False).collect()]
    assert kept[0] == {"post_id": "p1", "author_id": "a1", "created_at": "2024-01-05T10:00:00", "views_count": None}
    assert dropped[1] == {"post_id": "p1", "author_id": "a1", "created_at": "2024-01-05T10:00:00.250000"}


def test_lineage_is_cut_in_the_folder_the_session_names(spark):
    frame = cut_lineage(spark.range(3), "/nowhere")
    assert frame.count() == 3
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + spark.conf.get("spark.checkpoint.dir"))


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for day in (5, 6):
        write_lines(folder / f"2024010{day}.export.CSV", *[
            line(GlobalEventID=day * 10 + i, SQLDATE=f"2024010{day}", NumMentions=i, NumSources=1, NumArticles=1,
                 GoldsteinScale=1.5, AvgTone=-1, ActionGeo_Lat=1, ActionGeo_Long=2, EventCode="010",
                 SOURCEURL="https://x.org/storm-hits-coast")
            for i in range(3)
        ], line(GlobalEventID=99, SQLDATE="nope"))
    write_hits(folder / "vk_1.json", {"id": "1", "from_id": "a", "author": "Ann", "date": 1704448800,
                                      "likes": {"count": 4}, "text": "storm"})
    write_hits(folder / "tiktok_video_1.json", {"id": "2", "author_id": "b", "author": "Bo"})
    return folder


def test_files_become_tables_and_tables_become_derived_tables(spark, feed, tmp_path):
    root = str(tmp_path / "out")
    loaded = refresh.load_events(spark, str(feed / "*.CSV"), root)
    assert [(s.table, s.rows, s.ok) for s in loaded] == [
        ("events_read", 8, True), ("events", 6, True), ("event_rejects", 2, True)]
    assert [(s.table, s.rows) for s in refresh.load_posts(spark, str(feed / "*.json"), root)] == [
        ("truth_social_read", 0), ("tiktok_video_read", 1), ("vk_read", 1), ("post_rejects", 0), ("posts", 2)]
    assert {r["reject_reason"] for r in refresh.stored_rejects(spark, root).collect()} == {"bad_date"}
    stored_events, stored_posts = refresh.stored_events(spark, root), refresh.stored_posts(spark, root)
    statuses, ranking = refresh.refresh_all(stored_events, stored_posts, root, stop_words=[])
    assert refresh.succeeded(statuses)
    assert {s.table: s.rows for s in statuses} == {
        "daily_insights": 2, "geo_analysis": 1, "trend_analysis": 2, "top_mentions": 6,
        "social_temporal_metrics": 2, "top_authors_engagement": 2, "news_social_correlation": 1}
    assert [(r["keyword"], r["n"]) for r in ranking.collect()] == [("storm", 6), ("hits", 6), ("coast", 6)]
    assert [tuple(r) for r in spark.read.parquet(f"{root}/trend_analysis").orderBy("Date").collect()] == [
        (dt.date(2024, 1, 5), 3), (dt.date(2024, 1, 6), 3)]
    paired = spark.read.parquet(f"{root}/news_social_correlation")
    assert [tuple(r) for r in paired.select("Date", "mentions", "engagement").collect()] == [(dt.date(2024, 1, 5), 3, 4)]
    again, _ = refresh.refresh_all(stored_events, stored_posts, root, stop_words=[])
    assert refresh.succeeded(again) and spark.read.parquet(f"{root}/news_social_correlation").count() == 1


def test_loading_by_file_is_idempotent_and_appending_is_not(spark, feed, tmp_path):
    for by_file, expected in ((True, 6), (False, 12)):
        root = str(tmp_path / f"out_{by_file}")
        for _ in range(2):
            refresh.load_events(spark, str(feed / "*.CSV"), root, by_file=by_file)
        assert refresh.stored_events(spark, root).count() == expected


def test_empty_tables_fail_but_for_the_mentions(spark, tmp_path):
    none = with_event_date(events(spark, dict())).where("false")
    statuses, ranking = refresh.refresh_all(none, posts(spark, dict()).where("false"), str(tmp_path), stop_words=[])
    assert {s.table for s in statuses if s.ok} == {"top_mentions"}
    assert all(s.error is None for s in statuses) and ranking.count() == 0


def test_one_broken_input_does_not_stop_the_other_tables(spark, tmp_path):
    broken = with_event_date(events(spark, dict())).drop("GoldsteinScale")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    statuses, _ = refresh.refresh_all(broken, posts(spark, dict()), str(tmp_path), stop_words=[])
    assert {s.table for s in statuses if not s.ok} == {"daily_insights", "geo_analysis", "trend_analysis"}


def test_the_stored_table_is_pruned_by_day(spark, feed, tmp_path):
    table = str(tmp_path / "events")
    tables.append_rows(with_event_date(read_events(spark, str(feed / "*.CSV"))).where("event_date is not null"),
                       table, ["event_date"])
    plan = spark.read.parquet(table).where("event_date = date'2024-01-05'").select("NumMentions")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "ReadSchema: struct<NumMentions:int>" in text
    assert news.trend_analysis(spark.read.parquet(table)).count() == 2


def ingested(spark, feed, root, checkpoint, **options):
    query = ingest.ingest_events(spark, str(feed / "*.CSV"), root, checkpoint, **options)
    assert query.awaitTermination(240) and query.exception() is None
    return refresh.stored_events(spark, root).count(), refresh.stored_rejects(spark, root).count()


def test_every_new_file_is_ingested_once_with_its_rejects(spark, feed, tmp_path):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    assert ingested(spark, feed, root, checkpoint, files_per_batch=1) == (6, 2)
    assert ingested(spark, feed, root, checkpoint) == (6, 2)
    write_lines(feed / "20240107.export.CSV", line(GlobalEventID=70, SQLDATE="20240107"), "cut\toff",
                line(GlobalEventID="x", SQLDATE="20240107"))
    assert ingested(spark, feed, root, checkpoint) == (8, 4)
    reasons = [r["reject_reason"] for r in refresh.stored_rejects(spark, root).collect()]
    assert sorted(reasons) == ["bad_date", "bad_date", "bad_date", "malformed"]
    statuses, _ = refresh.refresh_news(refresh.stored_events(spark, root), root, stop_words=[])
    assert refresh.succeeded(statuses)


def test_two_checkpoints_do_not_erase_each_other(spark, feed, tmp_path):
    root, other = str(tmp_path / "out"), tmp_path / "other"
    other.mkdir()
    write_lines(other / "a.export.CSV", line(GlobalEventID=1, SQLDATE="20240105"))
    assert ingested(spark, feed, root, str(tmp_path / "one")) == (6, 2)
    assert ingested(spark, other, root, str(tmp_path / "two")) == (7, 2)


def test_a_batch_of_undated_lines_passes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_lines(folder / "a.export.CSV", line(GlobalEventID=1, SQLDATE="nope"))
    root = str(tmp_path / "out")
    assert ingested(spark, folder, root, str(tmp_path / "state")) == (0, 1)
    write_lines(folder / "b.export.CSV", line(GlobalEventID=2, SQLDATE="20240105"))
    assert ingested(spark, folder, root, str(tmp_path / "state")) == (1, 1)


def test_posts_stream_by_platform_by_the_same_guard_as_the_batch(spark, feed, tmp_path):
    (feed / "vk").mkdir()
    write_hits(feed / "VK_2.json", {"id": "3"})
    (feed / "vk_3.json").write_text("{cut off")
    root = str(tmp_path / "out")
    for platform in ("vk", "tiktok_video"):
        query = ingest.ingest_posts(spark, str(feed), platform, root, str(tmp_path / platform))
        assert query.awaitTermination(240) and query.exception() is None
    assert sorted((r["Platform"], r["post_id"]) for r in refresh.stored_posts(spark, root).collect()) == [
        ("tiktok_video", "2"), ("vk", "1"), ("vk", "3")]
    rejects = spark.read.parquet(f"{root}/post_rejects").collect()
    assert [(r["Platform"], r["file_name"], r["_corrupt_record"]) for r in rejects] == [("vk", "vk_3.json", "{cut off")]


def test_broken_and_truncated_post_files_are_reported(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    write_hits(folder / "tiktok_video_1.json", {"id": "1"}, {"id": "2"}, total=5)
    (folder / "vk_2.json").write_text("{cut off")
    found = {s.table: (s.rows, s.ok) for s in refresh.load_posts(spark, str(folder / "*.json"), root)}
    assert found == {"truth_social_read": (0, True), "tiktok_video_read": (2, True), "vk_read": (0, True),
                     "tiktok_video_truncated": (1, True), "post_rejects": (1, True), "posts": (2, True)}
    (folder / "tiktok_video_1.json").unlink()
    only_broken = {s.table: (s.rows, s.ok) for s in refresh.load_posts(spark, str(folder / "*.json"), str(tmp_path / "b"))}
    assert only_broken["post_rejects"] == (1, True) and only_broken["posts"] == (0, False)


def test_a_file_is_replaced_as_a_whole_and_by_its_path(spark, tmp_path):
    root = str(tmp_path / "out")
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    first, second = tmp_path / "a" / "x.export.CSV", tmp_path / "b" / "x.export.CSV"

    def load(path, *days_):
        write_lines(path, *[line(GlobalEventID=d, SQLDATE=f"2024010{d}") for d in days_])
        refresh.load_events(spark, str(path), root, by_file=True)
        return sorted(r["GlobalEventID"] for r in refresh.stored_events(spark, root).collect())

    assert load(first, 5, 6) == [5, 6]
    assert load(first, 5) == [5]
    assert load(second, 7) == [5, 7]
    write_hits(tmp_path / "a" / "vk_1.json", {"id": "1"}, {"id": "2"})
    for _ in range(2):
        refresh.load_posts(spark, str(tmp_path / "a" / "*.json"), root, by_file=True)
    assert refresh.stored_posts(spark, root).count() == 2


def test_empty_frames_and_files_are_written_as_nothing(spark, tmp_path):
    none = days(spark, (1, 1)).where("v > 5")
    assert tables.append_rows(none, str(tmp_path / "t"), ["Date"]) == 0
    assert tables.replace_partitions(none, str(tmp_path / "t"), ["Date"]) == 0
    assert tables.append_rows(days(spark, (1, 1)).limit(0), str(tmp_path / "t"), ["Date"]) == 0
    empty = tmp_path / "empty.export.CSV"
    empty.write_text("")
    for by_file in (False, True):
        statuses = refresh.load_events(spark, str(empty), str(tmp_path / "out"), by_file=by_file)
        assert [(s.table, s.rows, s.ok) for s in statuses] == [
            ("events_read", 0, True), ("events", 0, False), ("event_rejects", 0, True)]


def test_stored_rows_lie_in_the_order_that_readers_filter_by(spark, feed, tmp_path):
    root = str(tmp_path / "out")
    refresh.load_posts(spark, str(feed / "*.json"), root)
    refresh.load_events(spark, str(feed / "*.CSV"), root)
    rows = refresh.stored_events(spark, root).where("event_date = date'2024-01-05'").collect()
    assert [r["GlobalEventID"] for r in rows] == sorted(r["GlobalEventID"] for r in rows)
