"""Which row groups a reader of the stored tables has to touch."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from samples import events

from tidewatch.plans import refresh
from tidewatch.sinks import tables
from tidewatch.sources.events import with_event_date


def scanned(frame):
    """Rows that the file scan of an executed plan gave."""
    frame.collect()
    plan, found = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        metrics = node.metrics()
        if node.nodeName().startswith("Scan parquet"):
            found.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


def spread_events(spark, n=40000):
    return with_event_date(events(spark, dict())).drop("ActionGeo_Lat", "ActionGeo_Long", "GlobalEventID").crossJoin(spark.range(n)).select(
        "*", ((F.col("id") * 7919) % 1800 / 10 - 90).alias("ActionGeo_Lat"), ((F.col("id") * 104729) % 3600 / 10 - 180).alias("ActionGeo_Long"),
        ((F.col("id") * 48271) % 2147483647).cast("int").alias("GlobalEventID")).drop("id")


def groups(folder, box=None):
    """(row groups, those whose statistics meet the box)."""
    every = hit = 0
    for file in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            every += 1
            hit += all(stats[name].min <= high and stats[name].max >= low for name, (low, high) in (box or {}).items())
    return every, hit


def test_a_box_touches_few_row_groups_by_either_coordinate(spark, tmp_path):
    frame = spread_events(spark)
    order = refresh.event_order()
    tables.append_rows(frame, str(tmp_path / "near"), ["event_date"], sort_by=order, group_bytes=1 << 15)
    tables.append_rows(frame, str(tmp_path / "rows"), ["event_date"], sort_by=["ActionGeo_Lat", "ActionGeo_Long"], group_bytes=1 << 15)
    box = {"ActionGeo_Lat": (10.0, 20.0), "ActionGeo_Long": (10.0, 20.0)}
    every, hit = groups(tmp_path / "near", box)
    assert every >= 16 and hit <= every / 4
    # An order by latitude alone helps only half of the requests; this one helps a range of longitudes as well.
    longitudes = {"ActionGeo_Long": (10.0, 20.0)}
    assert groups(tmp_path / "near", longitudes)[1] < groups(tmp_path / "rows", longitudes)[1]
    inside = (F.col("ActionGeo_Lat").between(10, 20)) & (F.col("ActionGeo_Long").between(10, 20))
    read = spark.read.parquet(str(tmp_path / "near"))
    assert scanned(read.where(inside)) <= 40000 / 3
    assert read.where(inside).count() == frame.where(inside).count()


def test_one_id_touches_few_row_groups(spark, tmp_path):
    frame = spread_events(spark)
    for name, columns in (("with", refresh.EVENT_ID), ("without", None)):
        tables.append_rows(frame, str(tmp_path / name), ["event_date"], sort_by=refresh.event_order(), find_by=columns, group_bytes=1 << 15)
    wanted = 20000 * 48271 % 2147483647  # far from the least and the greatest
    # In groups as small as these the dictionaries of values would serve as well, which those of real size do not have.
    found = {name: spark.read.option("parquet.filter.dictionary.enabled", "false").parquet(str(tmp_path / name))
             .where(F.col("GlobalEventID") == wanted) for name in ("with", "without")}
    assert scanned(found["with"]) < scanned(found["without"]) / 4
    assert found["with"].count() == 1


def test_the_order_of_places_interleaves_their_bits(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (-90.0, 180.0), (90.0, -180.0), (None, 0.0), (float("nan"), 0.0), (500.0, -500.0), (0.0, 0.0)]
    found = [r[0] for r in spark.createDataFrame(rows, "a double, b double").select(tables.place_order("a", "b")).collect()]
    even, odd = sum(1 << i for i in range(0, 32, 2)), sum(1 << i for i in range(1, 32, 2))
    assert found[:4] == [0, even + odd, odd, even] and found[4] is found[5] is None and found[6] == even
    half = lambda v: sum(((v >> i) & 1) << (2 * i) for i in range(16))
    assert found[7] == half(32767) | half(32767) << 1
