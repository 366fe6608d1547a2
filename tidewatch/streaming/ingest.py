"""Each new file exactly once, by a file stream that stops when it has caught up."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.plans.refresh import save_events, save_posts
from tidewatch.schemas import EVENT_SCHEMA, with_corrupt_column
from tidewatch.sinks.publish import Files
from tidewatch.sinks.tables import Status
from tidewatch.sources.events import csv_options
from tidewatch.sources.posts import stream_envelopes


def _run(stream: DataFrame, save: Callable[[DataFrame, list[str]], list[Status]], checkpoint: str) -> StreamingQuery:
    """Write every micro-batch as a load of its own, named after checkpoint and batch number.

    Batch numbers restart with every checkpoint, so both are needed; the checkpoint counts by its full address, however
    it is spelled. A batch that is repeated after a failure takes the place of what its earlier attempt left.
    """
    source = hashlib.sha1(Files(stream.sparkSession, checkpoint).root.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        load = f"s{source}-{number}"
        for status in save(batch.withColumn("load", F.lit(load)), [load]):
            if status.error:
                raise RuntimeError(f"{status.table}: {status.error}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_events(spark: SparkSession, folder: str, root: str, checkpoint: str, *,
                  files_per_batch: int = 1000) -> StreamingQuery:
    """New day files into the event and reject tables under ``root``, as the batch load writes them."""
    stream = (
        spark.readStream.schema(with_corrupt_column(EVENT_SCHEMA)).options(**csv_options())
        .option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )
    return _run(stream, lambda batch, replaces: save_events(batch, root, replaces), checkpoint)


def ingest_posts(spark: SparkSession, folder: str, platform: str, root: str, checkpoint: str, *,
                 files_per_batch: int = 1000, options: dict | None = None) -> StreamingQuery:
    """One platform's new files into ``posts`` and ``post_rejects`` under ``root``.

    Every platform needs its own ``checkpoint``.
    """
    stream = stream_envelopes(spark, folder, platform, files_per_batch)
    return _run(stream, lambda batch, replaces: save_posts(
        {platform.lower(): batch}, root, {platform.lower(): options or {}}, replaces), checkpoint)
