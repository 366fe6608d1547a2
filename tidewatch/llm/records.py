"""Token sequences as length-delimited binary records, with an index of offsets beside each file.

A record is framed as

    length of the payload     8 bytes
    masked CRC-32 of those    4 bytes
    payload
    masked CRC-32 of it       4 bytes

with all numbers little-endian and the mask a rotation by 15 bits plus a constant, so that a checksum of data that
holds checksums stays telling. The payload is the document id (8 bytes), a presence byte for it, the width of a token
in bytes (2 where the vocabulary allows, else 4), and the tokens. The index has, for each record, its offset and the
number of tokens before it in its file (8 bytes each), so any record is found by its number alone. Each task writes files
of its own; ``manifest.json``, written when all tasks are done, names those that count, in order, so a repeated task
leaves at most files that no reader looks at.

Records are read in their order, or shuffled: a keyed permutation of the record numbers, computed where it is needed,
gives every reading task a stretch of the shuffled order. It looks up these records in the index and reads them alone.

Documents are in ascending order of their id, a null id first, equal ids in the order of their texts. Null texts are
empty and hold the end token alone. An empty table gives a manifest without files and no rows. A text, its tokens and its
record are held in memory as a whole.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewatch.llm.bpe import CachedPieces
from tidewatch.llm.storage import ManifestWriter, Written, committed, files
from tidewatch.llm.text import mixed, slices, texts

END_TOKEN = 2
MASK = 0xA282EAD8
FRAME = 16
HEAD = struct.Struct("<qBB")
# Bytes of records that one reading task takes on.
SPLIT_BYTES = 64 << 20


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def payload(doc_id: int | None, tokens: np.ndarray, width: int) -> bytes:
    return HEAD.pack(doc_id or 0, doc_id is not None, width) + tokens.astype(f"<u{width}").tobytes()


def unframed(data: memoryview) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, tokens) of each record; a wrong checksum or a cut-off record raises."""
    at = 0
    while at < len(data):
        length = bytes(data[at:at + 8])
        if len(length) < 8 or struct.unpack("<I", data[at + 8:at + 12])[0] != masked_crc(length):
            raise ValueError(f"damaged record length at {at}")
        size = struct.unpack("<Q", length)[0]
        body = bytes(data[at + 12:at + 12 + size])
        if len(body) < size or struct.unpack("<I", data[at + 12 + size:at + FRAME + size])[0] != masked_crc(body):
            raise ValueError(f"damaged record at {at}")
        doc_id, present, width = HEAD.unpack_from(body)
        yield doc_id if present else None, np.frombuffer(body, dtype=f"<u{width}", offset=HEAD.size)
        at += FRAME + size


class RecordWriter(ManifestWriter):
    """Writes (doc_id, ids) rows; ``ids`` are tokens as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, width: int, file_bytes: int) -> None:
        super().__init__(path)
        self.width, self.file_bytes = width, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = files(self.path)
        store.create_dir(folder, recursive=True)
        done = Written(TaskContext.get().partitionId())
        out = name = None
        offsets: list[int] = []
        before: list[int] = []
        size = tokens_before = 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                with store.open_output_stream(f"{folder}/{name}.index") as index:
                    index.write(np.column_stack((offsets, before)).astype("<u8").tobytes())
                done.files.append({"name": name, "index": f"{name}.index", "bytes": size, "records": len(offsets), "tokens": tokens_before})
                out = None

        for batch in iterator:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                if out is None:
                    name = f"part-{done.order:06d}-{len(done.files):04d}-{uuid.uuid4().hex}.records"
                    out, offsets, before, size, tokens_before = store.open_output_stream(f"{folder}/{name}"), [], [], 0, 0
                tokens = np.frombuffer(ids or b"", dtype="<u4")
                if len(tokens) and self.width == 2 and int(tokens.max()) > 0xFFFF:
                    raise ValueError("token beyond 65535 in records of two bytes a token")
                record = framed(payload(doc_id, tokens, self.width))
                offsets.append(size)
                before.append(tokens_before)
                out.write(record)
                size += len(record)
                tokens_before += len(tokens)
                if size >= self.file_bytes:
                    close()
        close()
        return done


@dataclass
class Stretch(InputPartition):
    name: str
    first: int
    records: int
    start: int


class RecordReader(DataSourceReader):
    """Rows (doc_id, start, n_tokens, ids); ``start`` is the number of tokens of all documents before."""

    def __init__(self, path: str, split_bytes: int) -> None:
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[Stretch]:
        stretches, start = [], 0
        for file in committed(self.path):
            pieces = -(-file["bytes"] // self.split_bytes)
            if pieces <= 1:
                stretches.append(Stretch(file["name"], 0, file["records"], start))
            else:
                index = self._index(file["name"])
                cuts = np.searchsorted(index[:, 0], np.arange(1, pieces) * self.split_bytes)
                edges = np.unique(np.concatenate(([0], cuts, [len(index)])))
                stretches += [Stretch(file["name"], int(i), int(j - i), start + int(index[i, 1]))
                              for i, j in zip(edges[:-1], edges[1:])]
            start += file["tokens"]
        return stretches

    def _index(self, name: str) -> np.ndarray:
        store, folder = files(self.path)
        with store.open_input_stream(f"{folder}/{name}.index") as file:
            return np.frombuffer(file.read(), dtype="<u8").reshape(-1, 2).astype(np.int64)

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.records:
            return
        store, folder = files(self.path)
        index = self._index(partition.name)[partition.first:partition.first + partition.records + 1, 0]
        start = partition.start
        with store.open_input_file(f"{folder}/{partition.name}") as file:
            ends = np.append(index[1:], file.size()) if len(index) == partition.records else index[1:]
            at = 0
            while at < partition.records:
                to = max(at + 1, int(np.searchsorted(ends, index[at] + (4 << 20), side="right")))
                file.seek(int(index[at]))
                found = list(unframed(memoryview(file.read(int(ends[to - 1] - index[at])))))
                counts = np.array([len(t) for _, t in found], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in found], pa.int64()), pa.array(start + np.cumsum(counts) - counts),
                     pa.array(counts), pa.array([t.astype("<u4").tobytes() for _, t in found], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
                start += int(counts.sum())
                at = to


def permuted(positions: np.ndarray, total: int, seed: int) -> np.ndarray:
    """The record number at each position of the shuffled order of ``total`` records.

    Four rounds of a Feistel network permute the numbers below the next power of four; what falls beyond ``total`` goes
    through them again, which leaves a permutation of the numbers below it.
    """
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    out, open_ = positions.astype(np.uint64), np.arange(len(positions))
    while len(open_):
        left, right = out[open_] >> half, out[open_] & low
        for turn in range(4):
            key = mixed(np.array([seed * 4 + turn], dtype=np.int64).view(np.uint64))
            left, right = right, left ^ (mixed(right + key) & low)
        out[open_] = (left << half) | right
        open_ = open_[out[open_] >= total]
    return out.astype(np.int64)


def read_ranges(file: pa.NativeFile, begins: np.ndarray, ends: np.ndarray, gap: int = 1 << 16) -> list[bytes]:
    """The bytes of ascending ranges; near ones are read together."""
    out: list[bytes] = []
    cuts = np.flatnonzero(begins[1:] - ends[:-1] > gap) + 1
    for first, last in zip(np.append(0, cuts), np.append(cuts, len(begins))):
        file.seek(int(begins[first]))
        data = file.read(int(ends[last - 1] - begins[first]))
        out += [data[i:j] for i, j in zip((begins[first:last] - begins[first]).tolist(), (ends[first:last] - begins[first]).tolist())]
    return out


@dataclass
class Positions(InputPartition):
    first: int
    records: int


class ShuffledReader(DataSourceReader):
    """The rows of ``RecordReader`` in an order that depends on the seed alone."""

    def __init__(self, path: str, seed: int, split_bytes: int) -> None:
        self.path, self.seed, self.files = path, seed, committed(path)
        self.total = sum(f["records"] for f in self.files)
        size = sum(f["bytes"] for f in self.files)
        self.each = max(1, self.total * split_bytes // max(size, 1))

    def partitions(self) -> list[Positions]:
        return [Positions(i, min(self.each, self.total - i)) for i in range(0, self.total, self.each)]

    def read(self, partition: Positions | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.records:
            return
        # At most about 4 MB of records at a time.
        step = max(1, min(partition.records, self.each * (4 << 20) // max(SPLIT_BYTES, 1)))
        for begin in range(partition.first, partition.first + partition.records, step):
            end = min(begin + step, partition.first + partition.records)
            yield self._rows(permuted(np.arange(begin, end), self.total, self.seed))

    def _rows(self, numbers: np.ndarray) -> pa.RecordBatch:
        store, folder = files(self.path)
        firsts = np.cumsum([0] + [f["records"] for f in self.files])
        starts = np.cumsum([0] + [f["tokens"] for f in self.files])
        order = np.argsort(numbers)
        owner = np.searchsorted(firsts, numbers[order], side="right") - 1
        found: list[tuple] = [()] * len(numbers)
        for which in np.unique(owner):
            file, mine = self.files[which], order[owner == which]
            local = numbers[mine] - firsts[which]
            with store.open_input_file(f"{folder}/{file['index']}") as index:
                entries = read_ranges(index, local * 16, np.minimum(local + 2, file["records"]) * 16)
            marks = [np.frombuffer(e, dtype="<u8").astype(np.int64).tolist() for e in entries]
            offsets = np.array([m[0] for m in marks])
            ends = np.array([m[2] if len(m) > 2 else file["bytes"] for m in marks])
            with store.open_input_file(f"{folder}/{file['name']}") as data:
                for place, mark, record in zip(mine.tolist(), marks, read_ranges(data, offsets, ends)):
                    (doc_id, tokens), = unframed(memoryview(record))
                    found[place] = (doc_id, int(starts[which]) + mark[1], len(tokens), tokens.astype("<u4").tobytes())
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)],
                                          names=["doc_id", "start", "n_tokens", "ids"])


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_records"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> RecordReader | ShuffledReader:
        split_bytes = int(self.options.get("split_bytes", SPLIT_BYTES))
        if "seed" in self.options:
            return ShuffledReader(self.options["path"], int(self.options["seed"]), split_bytes)
        return RecordReader(self.options["path"], split_bytes)

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], int(self.options.get("width", 4)),
                            int(self.options.get("file_bytes", 256 << 20)))


class LibraryPieces(CachedPieces):
    """The tokenizers library, asked once for each distinct piece that the cache holds."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter((i for ids in found for i in ids), dtype=np.int32, count=int(sizes.sum())), sizes


@functools.lru_cache(maxsize=2)
def library(path: str) -> LibraryPieces:
    return LibraryPieces(path)


def write_documents(docs: DataFrame, vocabulary: str, path: str, *, end_token: int = END_TOKEN) -> None:
    """Encode every document, end it with ``end_token``, and write all in ascending order of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library(vocabulary)
        for rows, parts in slices(batches):
            ids = [np.append(x, end_token).astype("<u4").tobytes() for x in encoder.encode(parts)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    docs.sparkSession.dataSource.register(RecordSource)
    # Texts are smaller than their tokens, so these travel, and each range is encoded where it is written. The beginnings of
    # texts part rows of one id or of none, and are short enough for the sample that finds the ranges.
    ordered = (texts(docs).repartitionByRange("doc_id", F.substring("text", 1, 64))
               .sortWithinPartitions("doc_id", "text"))
    with open(vocabulary, encoding="utf-8") as file:
        largest = max([end_token, *json.load(file)["model"]["vocab"].values()])
    (ordered.mapInArrow(run, "doc_id long, ids binary").write.format("token_records").mode("append")
     .option("path", path).option("width", 2 if largest < 1 << 16 else 4).save())


def read(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """All records in their order, or with a ``seed`` in a shuffled one: partition by partition, row by row."""
    spark.dataSource.register(RecordSource)
    reader = spark.read.format("token_records").option("path", path)
    return (reader if seed is None else reader.option("seed", seed)).load()
