"""Folders and files that driver and executors share."""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass, field

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

# Keys that a join sends to all tasks because they are the most frequent ones.
FREQUENT = 4096


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    Where it names none, a session on one machine takes a temporary folder; on a cluster, whose executors would each
    write to a disk of their own, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str, replaces: DataFrame | None = None) -> DataFrame:
    """The frame written to the shared folder as Parquet and read again: computed once, without lineage.

    ``replaces`` is a stored frame that nothing but ``df`` still needs: its files go once ``df`` is written.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, kind)
    df.write.option("compression", "zstd").parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.stored_in = folder
    if replaces is not None:
        discard(spark, replaces.stored_in)
    return out


def with_keys(rows: DataFrame, keys: DataFrame, on: list[str], number: str) -> DataFrame:
    """``rows`` with the columns of ``keys``, one row of which says for how many rows (``number``) it is.

    The ``FREQUENT`` most frequent keys go to the rows, so that theirs stay where they are; any other key is that of less
    than one row in ``FREQUENT``, and is joined by a shuffle.
    """
    few = stored(keys.orderBy(F.desc(number), *on).limit(FREQUENT), "frequent")
    names = F.broadcast(few.select(*on))
    rest = rows.join(names, on, "left_anti").join(keys.join(names, on, "left_anti"), on)
    return rows.join(F.broadcast(few), on).unionByName(rest)


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def files(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    """What one writing task leaves: its place in the order and its files."""

    order: int
    files: list[dict] = field(default_factory=list)


class ManifestWriter(DataSourceArrowWriter):
    """Tasks write files of their own names; a manifest made when all are done names those that count, in order."""

    def __init__(self, path: str) -> None:
        self.path = path

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = files(self.path)
        store.create_dir(folder, recursive=True)
        found = [f for m in sorted((m for m in messages if m), key=lambda m: m.order) for f in m.files]
        with store.open_output_stream(f"{folder}/manifest.json") as out:
            out.write(json.dumps({"files": found}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = files(self.path)
        for name in [n for m in messages if m for f in m.files for n in (f["name"], f.get("index")) if n]:
            store.delete_file(f"{folder}/{name}")


def committed(path: str) -> list[dict]:
    """The files that a manifest names."""
    store, folder = files(path)
    with store.open_input_stream(f"{folder}/manifest.json") as file:
        return json.loads(file.read())["files"]
