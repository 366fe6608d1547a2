import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from raw import line, write_hits, write_lines

from tidewatch.schemas import EVENT_SCHEMA, PLATFORMS, get_schema
from tidewatch.sources import events, manifest, posts


def test_event_schema_has_its_58_nullable_columns():
    assert len(EVENT_SCHEMA) == 58 and all(f.nullable for f in EVENT_SCHEMA)
    assert [EVENT_SCHEMA.names[i] for i in (0, 1, 5, 15, 25, 35, 49, 57)] == [
        "GlobalEventID", "SQLDATE", "Actor1Code", "Actor2Code", "IsRootEvent", "Actor1Geo_Type",
        "ActionGeo_Type", "SOURCEURL"]
    assert sum(isinstance(f.dataType, T.DoubleType) for f in EVENT_SCHEMA) == 9


def test_schema_lookup_ignores_case_and_names_the_choices():
    assert get_schema("TikTok_Video") == get_schema("tiktok_video")
    with pytest.raises(ValueError, match="truth_social, tiktok_video, vk"):
        get_schema("myspace")


@pytest.fixture
def raw(tmp_path):
    write_lines(
        tmp_path / "20240105.export.CSV",
        line(GlobalEventID=1, SQLDATE="20240105", NumMentions=7, Actor1Name='"open', EventCode="010"),
        line(GlobalEventID=2, SQLDATE="20240105", NumMentions="seven", GoldsteinScale="x", EventCode="011"),
        "3\t20240105\t202401",
        line(GlobalEventID=4, SQLDATE="20240105", EventCode="012") + "\textra\tmore",
        line(GlobalEventID=5, SQLDATE="20240105", EventCode="013") + "\tz" * 40,
        line(GlobalEventID=6, SQLDATE="20240199", EventCode="014"),
        line(GlobalEventID=7, EventCode="015"),
        line(GlobalEventID=8, SQLDATE="--", EventCode="016"),
    )
    return str(tmp_path)


def test_malformed_lines_lose_fields_not_the_file(spark, raw):
    rows = {r["GlobalEventID"]: r for r in events.read_events(spark, raw).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert (rows[1]["Actor1Name"], rows[1]["NumMentions"], rows[1]["EventCode"]) == ('"open', 7, "010")
    assert (rows[2]["NumMentions"], rows[2]["GoldsteinScale"], rows[2]["EventCode"]) == (None, None, "011")
    assert (rows[3]["MonthYear"], rows[3]["EventCode"]) == (202401, None)
    assert (rows[4]["EventCode"], rows[5]["EventCode"], rows[7]["SQLDATE"]) == ("012", "013", None)


def test_the_usual_quote_swallows_fields_when_asked_for(spark, raw):
    row = events.read_events(spark, raw, quote='"').where("GlobalEventID = 1").first()
    assert row["EventCode"] is None


def test_rejects_are_listed_and_dated_events_kept(spark, raw):
    good, bad = events.split_rejects(events.read_events(spark, raw, keep_corrupt=True))
    assert sorted(r["GlobalEventID"] for r in good.collect()) == [1, 2, 3, 4, 5]
    assert good.first()["event_date"] == dt.date(2024, 1, 5) and "_corrupt_record" not in good.columns
    assert {r["GlobalEventID"]: r["reject_reason"] for r in bad.collect()} == {
        2: "malformed", 3: "malformed", 4: "malformed", 5: "malformed",
        6: "bad_date", 7: "bad_date", 8: "bad_date"}


def test_column_parse_equals_the_file_scan(spark, raw):
    scanned = events.read_events(spark, raw).select("GlobalEventID", "SQLDATE", "NumMentions", "EventCode")
    parsed = events.parse_event_lines(spark.read.text(raw)).select(scanned.columns)
    assert sorted(scanned.collect()) == sorted(parsed.collect())


def test_audit_columns_and_counts_in_one_pass(spark, raw):
    counted, seen = events.counted(events.with_audit(events.read_events(spark, raw)), "rows")
    assert dict(counted.dtypes)["ProcessedDate"] == "timestamp" and dict(counted.dtypes)["ProcessingDate"] == "date"
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 8


def test_files_are_chosen_by_platform_name_and_unnested(spark, tmp_path):
    write_hits(tmp_path / "vk_20240101_20240104.json", {"id": "1", "text": "a"}, None, {"id": 7, "from_id": 9})
    write_hits(tmp_path / "TIKTOK_VIDEO_x.json", {"id": "t"}, total=5)
    (tmp_path / "vk_empty.json").write_text(json.dumps({"hits": {"hits": []}}))
    (tmp_path / "vk_none.json").write_text(json.dumps({"hits": {}}))
    (tmp_path / "vk_broken.json").write_text("{not json")
    envelopes = posts.read_envelopes(spark, str(tmp_path), "VK")
    rows = posts.unnest_hits(envelopes).select("id", "text", "from_id").collect()
    assert sorted(map(tuple, rows), key=repr) == [("1", "a", None), ("7", None, "9"), (None, None, None)]
    held = {r["file_name"]: r["held_hits"] for r in posts.hit_counts(envelopes).collect()}
    assert held == {"vk_20240101_20240104.json": 3, "vk_empty.json": 0, "vk_none.json": 0, "vk_broken.json": 0}
    (tiktok,) = posts.hit_counts(posts.read_envelopes(spark, str(tmp_path), "tiktok_video")).collect()
    assert tuple(tiktok) == ("TIKTOK_VIDEO_x.json", 5, 1, True)
    broken = posts.read_envelopes(spark, str(tmp_path), "vk", keep_corrupt=True).where("_corrupt_record is not null")
    assert [r["file_name"] for r in broken.select("file_name", "hits").collect()] == ["vk_broken.json"]


def test_a_bad_nested_type_spares_its_siblings(spark):
    text = json.dumps({"hits": {"hits": [{"_source": {"id": "1", "post_source": {"type": "api"}, "likes": {"count": 3}}}]}})
    frame = posts.unnest_hits(posts.parse_envelopes(spark.createDataFrame([(text,)], "value string"), "vk"))
    row = frame.first()
    assert (row["id"], row["post_source"], row["likes"]["count"]) in [("1", None, 3), ("1", (None,), 3)]


def test_read_posts_unites_the_platforms(spark, tmp_path):
    write_hits(tmp_path / "vk_a.json", {"id": "1", "marked_as_ads": 1})
    write_hits(tmp_path / "tiktok_video_a.json", {"id": "2", "isAd": True})
    write_hits(tmp_path / "truth_social_a.json", {"id": "3", "sponsored": False})
    frame = posts.read_posts(spark, str(tmp_path), PLATFORMS, options={"vk": {"vk_ads_as_sponsored": True}})
    assert {(r["Platform"], r["post_id"], r["is_sponsored"]) for r in frame.collect()} == {
        ("vk", "1", True), ("tiktok_video", "2", True), ("truth_social", "3", False)}


def bounds(spark, start, end, **more):
    frame = spark.sql(f"select timestamp '{start}' as start, timestamp '{end}' as end")
    return frame.withColumns({k: F.lit(v) for k, v in more.items()})


def test_daily_plan_includes_both_ends_and_lists_missing_days(spark):
    plan = manifest.daily_file_plan(bounds(spark, "2024-02-28 13:00:00", "2024-03-01 01:00:00"))
    names = [r["file_name"] for r in plan.orderBy("day").collect()]
    assert names == ["20240228.export.CSV", "20240229.export.CSV", "20240301.export.CSV"]
    present = spark.createDataFrame([("20240229.export.CSV",)], "file_name string")
    assert [r["file_name"] for r in manifest.missing_files(plan, present).orderBy("day").collect()] == [
        names[0], names[2]]
    assert manifest.daily_file_plan(bounds(spark, "2024-03-02 00:00:00", "2024-03-01 00:00:00")).count() == 0


def test_window_plan_clips_the_last_window_and_is_half_open(spark):
    plan = manifest.window_file_plan(bounds(spark, "2024-01-01 06:00:00", "2024-01-08 06:00:00", Platform="vk"))
    assert [r["file_name"] for r in plan.orderBy("window_start").collect()] == [
        "vk_20240101_20240104.json", "vk_20240104_20240107.json", "vk_20240107_20240108.json"]
    whole = manifest.window_file_plan(bounds(spark, "2024-01-01 00:00:00", "2024-01-07 00:00:00", Platform="vk"))
    assert whole.count() == 2
    assert manifest.window_file_plan(bounds(spark, "2024-01-01 00:00:00", "2024-01-01 00:00:00", Platform="vk")).count() == 0
