"""Tables keep their rows until the new ones are complete, and interrupted changes are completed."""

import hashlib

import pytest
from pyspark.sql import functions as F
from raw import line, write_hits, write_lines

from tidewatch.plans import refresh
from tidewatch.sinks import publish, tables
from tidewatch.sources import events as event_source
from tidewatch.streaming import ingest


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def read(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def left_over(folder):
    return [p.name for p in folder.rglob("_*") if p.name != "_SUCCESS"]


def test_a_failing_replacement_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(numbers(spark, 1, 2), path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("v"))
    status = tables.write_status("t", lambda: tables.replace_table(broken.repartition(4), path))
    assert not status.ok and read(spark, path) == [1, 2]
    assert left_over(tmp_path) == []


def test_a_table_may_be_computed_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(numbers(spark, 1, 2), path)
    assert tables.replace_table(spark.read.parquet(path).select((F.col("v") + 1).alias("v")), path) == 2
    assert read(spark, path) == [2, 3]


@pytest.mark.parametrize("moves_before_the_crash", [0, 1, 2, 3])
def test_an_interrupted_change_is_completed(spark, tmp_path, monkeypatch, moves_before_the_crash):
    """Whatever moves were made when the process died, the next writer makes the others."""
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "one", 1), ("b", "one", 2), ("a", "two", 3)], "kind string, load string, v long")
    tables.append_rows(rows, path, ["kind", "load"])
    new = spark.createDataFrame([("a", "one", 10), ("c", "one", 30)], "kind string, load string, v long")
    move, made = publish.Files.move, []

    def dying(self, source, target):
        if not source.startswith("_draft"):
            made.append(source)
            if len(made) > moves_before_the_crash:
                raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(publish.Files, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_loads(new, path, ["kind", "load"], ["one"], spark=spark)
    monkeypatch.undo()
    publish.settle(publish.Files(spark, path))
    assert sorted((r.kind, r.load, r.v) for r in spark.read.parquet(path).collect()) == [("a", "one", 10), ("a", "two", 3), ("c", "one", 30)]
    assert left_over(tmp_path) == []


@pytest.fixture
def loaded(spark, tmp_path):
    root, feed = str(tmp_path / "out"), tmp_path / "in"
    feed.mkdir()
    write_lines(feed / "a.export.CSV", *[line(GlobalEventID=d, SQLDATE=f"2024010{d}") for d in (5, 6)], "cut\toff")
    refresh.load_events(spark, str(feed), root, by_file=True)
    return feed, root


def stored(spark, root):
    return sorted(r["GlobalEventID"] for r in refresh.stored_events(spark, root).collect())


def test_a_failing_load_leaves_what_its_files_gave_before(spark, loaded, monkeypatch):
    feed, root = loaded
    routed = event_source.routed
    monkeypatch.setattr(event_source, "routed", lambda rows: routed(rows).withColumn(
        "GlobalEventID", F.when(F.col("GlobalEventID") == 8, F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("GlobalEventID"))))
    write_lines(feed / "a.export.CSV", *[line(GlobalEventID=d, SQLDATE=f"2024010{d}") for d in (7, 8)])
    failed = refresh.load_events(spark, str(feed), root, by_file=True)
    assert not refresh.succeeded(failed) and stored(spark, root) == [5, 6]
    monkeypatch.undo()
    assert refresh.succeeded(refresh.load_events(spark, str(feed), root, by_file=True))
    assert stored(spark, root) == [7, 8] and refresh.stored_rejects(spark, root).count() == 0


def test_a_mended_post_file_loses_its_reject(spark, tmp_path):
    root = str(tmp_path / "out")
    (tmp_path / "vk_1.json").write_text("{cut off")
    write_hits(tmp_path / "vk_2.json", {"id": "2"})
    refresh.load_posts(spark, str(tmp_path / "*.json"), root, by_file=True)
    assert spark.read.parquet(f"{root}/post_rejects").count() == 1
    write_hits(tmp_path / "vk_1.json", {"id": "1"})
    refresh.load_posts(spark, str(tmp_path / "*.json"), root, by_file=True)
    assert sorted(r["post_id"] for r in refresh.stored_posts(spark, root).collect()) == ["1", "2"]
    assert list((tmp_path / "out" / "post_rejects").rglob("*.parquet")) == []


def test_a_checkpoint_has_one_name_however_it_is_spelled(spark, loaded, tmp_path):
    feed, _ = loaded
    names = set()
    for i, state in enumerate((f"{tmp_path}/state", f"file:{tmp_path}/state", f"file://{tmp_path}/state/")):
        root = str(tmp_path / f"copy{i}")
        query = ingest.ingest_events(spark, str(feed), root, state)
        assert query.awaitTermination(240) and query.exception() is None
        names |= {p.name for p in (tmp_path / f"copy{i}").rglob("load=*")} if i == 0 else set()
        names.add(f"load=s{hashlib.sha1(publish.Files(spark, state).root.encode()).hexdigest()[:16]}-0")
    assert len(names) == 1
