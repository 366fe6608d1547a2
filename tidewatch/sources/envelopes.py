"""Search results cut into their hits while they are read, so that one file can be the work of several tasks.

Every task takes the hits that begin within its stretch of a file. It has to know where strings and hits begin there, so it
runs over the bytes before its stretch as well, but only to follow quotes and brackets, some megabytes at a time. No task
holds more than that and a single hit. A file that breaks off gives the hits before the break and a row for the rest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewatch.schemas import get_schema

SPLIT_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
# What may lie between a key and its value, and how much of the text around the hits is kept to find the announced total.
KEY_BYTES, HEAD_BYTES = 64, 1 << 16
SCHEMA = "kind string, file_path string, file_name string, hit string, announced long"
HITS_KEY = re.compile(rb'"hits"\s*:\s*\Z')
TOTAL = re.compile(rb'"total"\s*:\s*\{\s*"value"\s*:\s*(\d+)')


class Brackets:
    """Brackets outside strings, with the depth each leaves, from chunks of a text."""

    def __init__(self) -> None:
        self.depth, self.in_string, self.escaped = 0, False, False

    def feed(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, the brackets there, depth after each)."""
        chars = np.frombuffer(data, dtype=np.uint8)
        quotes = chars == 34
        back = np.flatnonzero(chars == 92)
        plain = np.ones(len(chars), dtype=bool)
        carried = False
        if len(back):
            first = np.flatnonzero(np.diff(back, prepend=-2) != 1)
            sizes = np.diff(np.append(first, len(back)))
            begins = back[first]
            # A run that goes on from an escaped first character begins behind it.
            shift = ((begins == 0) & self.escaped).astype(np.int64)
            odd = begins + sizes
            odd = odd[(sizes - shift) % 2 == 1]
            carried = bool(len(odd)) and int(odd[-1]) == len(chars)
            plain[odd[odd < len(chars)]] = False
        if self.escaped and len(chars):
            plain[0] = False
        self.escaped = carried if len(chars) else self.escaped
        quotes &= plain
        inside = (np.cumsum(quotes) + self.in_string) % 2 == 1
        if len(chars):
            self.in_string = bool(inside[-1])
        opens = (chars == 123) | (chars == 91)
        closes = (chars == 125) | (chars == 93)
        at = np.flatnonzero((opens | closes) & ~inside)
        depth = self.depth + np.cumsum(np.where(opens[at], 1, -1))
        if len(at):
            self.depth = int(depth[-1])
        return at, chars[at], depth


class Cutter:
    """The hits of one envelope, ``{"hits": {"hits": [...]}}``, as they end; what lies around them is kept up to a bound."""

    def __init__(self, begin: int, end: int) -> None:
        self.begin, self.end = begin, end
        self.brackets, self.at = Brackets(), 0
        self.outer = self.listed = False
        self.done = False
        self.hit: bytearray | None = None
        self.started = -1
        self.around, self.last = bytearray(), b""

    def feed(self, data: bytes) -> Iterator[bytes]:
        """Hits that end within this chunk and begin within the stretch."""
        text = self.last + data
        shift = len(self.last)
        taken = 0
        places, marks, depths = self.brackets.feed(data)
        shallow = depths <= 4
        for place, mark, depth in zip(places[shallow].tolist(), marks[shallow].tolist(), depths[shallow].tolist()):
            if mark == 123 and depth == 2:
                self.outer = HITS_KEY.search(text[max(0, place + shift - KEY_BYTES):place + shift]) is not None
            elif mark == 91 and depth == 3 and self.outer and not self.listed:
                self.listed = HITS_KEY.search(text[max(0, place + shift - KEY_BYTES):place + shift]) is not None
                self._keep(data[taken:place])
            elif self.listed and mark == 123 and depth == 4:
                self.started = self.at + place
                self.hit = bytearray() if self.begin <= self.started < self.end else None
                taken = place
            elif self.listed and mark == 125 and depth == 3:
                if self.hit is not None:
                    self.hit += data[taken:place + 1]
                    yield bytes(self.hit)
                self.hit, self.started, taken = None, -1, place + 1
            elif self.listed and mark == 93 and depth == 2:
                self.listed, self.outer, taken = False, False, place
            elif depth == 0:
                self.done = True
        if self.hit is not None:
            self.hit += data[taken:]
        elif self.started < 0 and not self.listed:
            self._keep(data[taken:])
        self.last = text[-KEY_BYTES:]
        self.at += len(data)

    def _keep(self, data: bytes) -> None:
        self.around += data[:max(0, HEAD_BYTES - len(self.around))]

    @property
    def behind(self) -> bool:
        """Whether no further hit can begin within the stretch."""
        return self.hit is None and self.at >= self.end

    @property
    def announced(self) -> int | None:
        found = TOTAL.search(bytes(self.around))
        return int(found.group(1)) if found else None


@dataclass
class Stretch(InputPartition):
    path: str
    begin: int
    end: int
    size: int


def opened(path: str) -> pa.NativeFile:
    if re.match("file:|/", path):
        return pyarrow.fs.LocalFileSystem().open_input_stream(re.sub("^file:/+", "/", path))
    store, name = pyarrow.fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


class HitReader(DataSourceReader):
    """Rows of kind ``hit`` for every hit, ``envelope`` for every whole file and ``reject`` for what is left of a broken one."""

    def __init__(self, files: list[tuple[str, int]], split_bytes: int) -> None:
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> list[Stretch]:
        return [Stretch(path, begin, min(begin + self.split_bytes, size), size)
                for path, size in self.files for begin in range(0, max(size, 1), self.split_bytes)]

    def read(self, partition: Stretch | None) -> Iterator[tuple]:
        if partition is None:
            return
        path, name = partition.path, partition.path.rsplit("/", 1)[-1]
        cutter = Cutter(partition.begin, partition.end)
        last = partition.end >= partition.size
        with opened(path) as file:
            while data := file.read(CHUNK_BYTES):
                for hit in cutter.feed(data):
                    yield "hit", path, name, hit.decode("utf-8", "replace"), None
                if cutter.behind and not last:
                    return
        if cutter.hit is not None or last and not cutter.done:
            yield "reject", path, name, bytes(cutter.hit or cutter.last).decode("utf-8", "replace"), cutter.announced
        elif last:
            yield "envelope", path, name, None, cutter.announced


class HitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "search_hits"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HitReader:
        return HitReader([tuple(f) for f in json.loads(self.options["files"])], int(self.options.get("split_bytes", SPLIT_BYTES)))


def listed(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """(address, bytes) of the files that paths, patterns and folders name."""
    found = []
    for text in [paths] if isinstance(paths, str) else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in store.globStatus(path) or []:
            for file in store.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if file.isFile() and not file.getPath().getName().startswith(("_", ".")):
                    found.append((file.getPath().toString(), file.getLen()))
    return sorted(set(found))


def read_rows(spark: SparkSession, paths: str | list[str], platform: str, *, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Hits, whole files and rests of the files with the platform's name in their path, in any case."""
    spark.dataSource.register(HitSource)
    files = [f for f in listed(spark, paths) if platform.lower() in f[0].lower()]
    return spark.read.format("search_hits").option("files", json.dumps(files)).option("split_bytes", split_bytes).load()


def sources_of(rows: DataFrame, platform: str, *keep: str) -> DataFrame:
    """The fields of every hit's source, as ``posts.unnest_hits`` gives them; the parse sits in a generator."""
    hit = get_schema(platform)["hits"].dataType["hits"].dataType.elementType
    parsed = F.from_json("hit", hit.simpleString(), {"mode": "PERMISSIVE"})
    return rows.where("kind = 'hit'").select(*keep, F.inline(F.array(parsed))).select(*keep, "_source.*")


def hit_counts(rows: DataFrame) -> DataFrame:
    """Per file: hits announced and held, and whether it holds fewer or breaks off."""
    counted = rows.groupBy("file_path", "file_name").agg(
        F.max("announced").alias("total_hits"), F.count_if(F.col("kind") == "hit").alias("held_hits"),
        F.count_if(F.col("kind") == "reject").alias("_broken"))
    return counted.select("file_path", "file_name", "total_hits", "held_hits", (
        (F.col("_broken") > 0) | F.coalesce(F.col("total_hits") > F.col("held_hits"), F.lit(False))).alias("truncated"))
