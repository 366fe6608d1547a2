"""WARC archives as a Spark data source: one gzip member per record, headers parsed before payloads.

Reading plans one task per file of a manifest, or per ``.warc`` or ``.warc.gz`` file of a folder without one. Equality
and membership predicates on the record type and on other header columns are pushed into the scan. A record's headers
are parsed first; where they fail a predicate, or where no payload is asked for (leave it out of the schema given to
the reader), the payload is not inflated: the writer notes each member's packed size in the gzip header's extra field
"sl", so the scan moves on by it. Members of other writers lack it and are inflated to find their end, in pieces that
are thrown away.

Writing takes (page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload) rows. A revisit holds no
payload, only the digest and the size of the one it repeats, and the id of the record that has it.

Archives of other writers are read alike: ``record_id``, ``refers_to_id``, ``date`` and ``content_type`` hold their
headers as they are, and only this writer's ids become ``page_id`` and ``refers_to``. A payload is what follows the HTTP
headers where the record says that it holds HTTP, else the whole block.

Null payloads are empty. Null ids are written as ``null`` and read back as null; null addresses are left out. Line
breaks within an address are percent-encoded. An empty table makes an archive without records. A record's payload is
held in memory as a whole. A damaged or cut-off file raises an error that names it and the place of the record.
"""

from __future__ import annotations

import base64
import binascii
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tidewatch.llm.storage import ManifestWriter, Written, committed, files

SCHEMA = ("page_id long, record_type string, target_uri string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary, record_id string, refers_to_id string, date string, content_type string")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
# Payloads from this size on are stored once.
REVISIT_BYTES = 1000
GZIP = struct.Struct("<BBBBIBBH2sHII")


def record(row: dict[str, Any], date: str) -> bytes:
    revisit = row["record_type"] == "revisit"
    block = HTTP if revisit else HTTP + (row["payload"] or b"")
    digest = base64.b32encode(binascii.unhexlify(row["payload_digest"])).decode()
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{ID}{_written(row['page_id'])}>"),
               ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", row["payload_bytes"]),
               ("Content-Length", len(block))]
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{_written(row['refers_to'])}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _written(number: int | None) -> str:
    return "null" if number is None else str(number)


def _read_id(text: str | None) -> int | None:
    name = (text or "").strip("<>")
    number = name.removeprefix(ID)
    return int(number) if name.startswith(ID) and number.lstrip("-").isdigit() else None


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field "sl" holds its packed and its plain size."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = GZIP.size + len(body) + 8
    head = GZIP.pack(0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class WarcWriter(ManifestWriter):
    def __init__(self, path: str, level: int, file_bytes: int, date: str) -> None:
        super().__init__(path)
        self.level, self.file_bytes, self.date = level, file_bytes, date

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = files(self.path)
        store.create_dir(folder, recursive=True)
        done, out, name, size = Written(TaskContext.get().partitionId()), None, "", 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        name = f"part-{done.order:06d}-{len(done.files):04d}-{uuid.uuid4().hex}.warc.gz"
                        out, size = store.open_output_stream(f"{folder}/{name}", compression=None), 0
                    packed = member(record(row, self.date), self.level)
                    out.write(packed)
                    size += len(packed)
                    if size >= self.file_bytes:
                        out.close()
                        done.files.append({"name": name, "bytes": size})
                        out = None
        if out is not None:
            out.close()
            done.files.append({"name": name, "bytes": size})
        return done


@dataclass
class ArchiveFile(InputPartition):
    name: str


class Bytes:
    """Forward reading of a file with a small buffer; skipping does not read."""

    def __init__(self, file: pyarrow.NativeFile, ahead: int = 1 << 16) -> None:
        self.file, self.ahead, self.data, self.at = file, ahead, b"", 0

    def peek(self, n: int) -> bytes:
        if len(self.data) - self.at < n:
            self.data = self.data[self.at:] + self.file.read(max(n, self.ahead))
            self.at = 0
        return self.data[self.at:self.at + n]

    def take(self, n: int) -> bytes:
        got = self.peek(n)
        self.at += len(got)
        return got

    def skip(self, n: int) -> None:
        left = len(self.data) - self.at
        if n <= left:
            self.at += n
        else:
            self.file.seek(self.file.tell() + n - left)
            self.data, self.at = b"", 0


class Member:
    """The plain bytes of one gzip member, inflated only as far as asked for."""

    def __init__(self, source: Bytes) -> None:
        self.source, self.inflate, self.used = source, zlib.decompressobj(31), 0
        head = source.peek(GZIP.size)
        self.size = None
        if len(head) == GZIP.size:
            *_, flags, _, _, _, extra, kind, length, packed, _ = GZIP.unpack(head)
            if flags & 4 and extra == 12 and kind == b"sl" and length == 8:
                self.size = packed

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n and not self.inflate.eof:
            chunk = self.inflate.unconsumed_tail or self._more()
            if not chunk:
                raise ValueError("cut-off gzip member")
            out += self.inflate.decompress(chunk, n - len(out))
        return out

    def _more(self) -> bytes:
        data = self.source.take(1 << 14)
        self.used += len(data)
        return data

    def close(self) -> None:
        """Put the file behind this member."""
        if self.size is not None and self.used <= self.size:
            self.source.skip(self.size - self.used)
        elif self.size is not None:
            self.source.at -= self.used - self.size
        else:
            while not self.inflate.eof:
                self.read(1 << 16)
            self.source.at -= len(self.inflate.unused_data)


class Plain:
    """The bytes of an archive that is not compressed."""

    def __init__(self, source: Bytes) -> None:
        self.source, self.left = source, None

    def read(self, n: int) -> bytes:
        got = self.source.take(n)
        if self.left is not None:
            self.left -= len(got)
        return got

    def close(self) -> None:
        self.source.skip(self.left or 0)


def headers(part: Member | Plain) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and what was read beyond them."""
    data = b""
    while (end := data.find(b"\r\n\r\n")) < 0:
        got = part.read(2048)
        if not got:
            raise ValueError("record without end of headers")
        data += got
    version, *lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields: dict[str, str] = {}
    for line in lines:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, data[end + 4:]


def columns(fields: dict[str, str]) -> dict[str, Any]:
    digest = fields.get("warc-payload-digest")
    if digest is not None and digest.lower().startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:].upper()).hex()
    size = fields.get("x-payload-length")
    if size is None and not holds_http(fields):
        size = fields.get("content-length")
    return {"page_id": _read_id(fields.get("warc-record-id")), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"), "refers_to": _read_id(fields.get("warc-refers-to")),
            "payload_digest": digest, "payload_bytes": int(size) if size else None,
            "record_id": fields.get("warc-record-id"), "refers_to_id": fields.get("warc-refers-to"),
            "date": fields.get("warc-date"), "content_type": fields.get("content-type")}


def holds_http(fields: dict[str, str]) -> bool:
    return fields.get("content-type", "").partition(";")[0].strip().lower() == "application/http"


def payload_of(block: bytes, fields: dict[str, str]) -> bytes | None:
    """What a record holds: the body of an HTTP message, any other block whole; a revisit's is elsewhere."""
    if fields.get("warc-type") == "revisit":
        return None
    if not holds_http(fields):
        return block
    end = re.search(rb"\r?\n\r?\n", block)
    return block[end.end():] if end else b""


class WarcReader(DataSourceReader):
    def __init__(self, path: str, wanted: list[str]) -> None:
        self.path, self.wanted = path, wanted
        self.allowed: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for predicate in filters:
            name = predicate.attribute[0] if isinstance(predicate, (EqualTo, In)) else None
            if name in (None, "payload"):
                yield predicate
            else:
                values = set(predicate.value) if isinstance(predicate, In) else {predicate.value}
                self.allowed[name] = self.allowed.get(name, values) & values

    def partitions(self) -> list[ArchiveFile]:
        store, folder = files(self.path)
        if store.get_file_info(f"{folder}/manifest.json").type != pyarrow.fs.FileType.NotFound:
            return [ArchiveFile(f["name"]) for f in committed(self.path)]
        found = store.get_file_info(pyarrow.fs.FileSelector(folder))
        return [ArchiveFile(f.base_name) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]

    def read(self, partition: ArchiveFile | None) -> Iterator[tuple]:
        if partition is None:
            return
        store, folder = files(self.path)
        packed = partition.name.endswith(".gz")
        with store.open_input_file(f"{folder}/{partition.name}") as file:
            source, number = Bytes(file), 0
            while source.peek(1):
                try:
                    row = self._record(Member(source) if packed else Plain(source))
                except (ValueError, zlib.error) as error:
                    raise ValueError(f"{partition.name}: record {number}: {error}") from error
                number += 1
                if row is not None:
                    yield row

    def _record(self, part: Member | Plain) -> tuple | None:
        """The columns asked for, None where the headers fail a predicate; the file is behind the record then."""
        fields, rest = headers(part)
        size = int(fields.get("content-length") or 0)
        left = size + 4 - len(rest)
        if isinstance(part, Plain):
            part.source.at += min(left, 0)  # read into the next record
            part.left = max(left, 0)
        row, found = columns(fields), None
        # Other writers do not state how long the body of an HTTP message is.
        unsized = "payload_bytes" in self.wanted and row["payload_bytes"] is None and row["record_type"] != "revisit"
        needed = unsized or "payload_bytes" in self.allowed and row["payload_bytes"] is None
        if needed or all(row[k] in v for k, v in self.allowed.items()):
            if "payload" in self.wanted or needed:
                block = (rest + part.read(max(left, 0)))[:size]
                if len(block) < size:
                    raise ValueError("cut-off record")
                row["payload"] = payload_of(block, fields)
                if row["payload_bytes"] is None and row["payload"] is not None:
                    row["payload_bytes"] = len(row["payload"])
            if all(row[k] in v for k, v in self.allowed.items()):
                found = tuple(row[k] for k in self.wanted)
        part.close()
        return found


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("level", 1)),
                          int(self.options.get("file_bytes", 128 << 20)),
                          self.options.get("date", "1970-01-01T00:00:00Z"))


def write_pages(pages: DataFrame, path: str, *, revisit_bytes: int = REVISIT_BYTES) -> None:
    """One record per page. Of equal payloads of at least ``revisit_bytes``, the page with the largest id holds it."""
    pages.sparkSession.dataSource.register(WarcSource)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    # Only payloads that occur again travel as (digest, id); the counts combine before the shuffle.
    holders = (known.filter(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest")
               .agg(F.max("page_id").alias("holder"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    (known.join(holders, "payload_digest", "left").select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("holder")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))
     .write.format("warc").mode("append").option("path", path).save())


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records of an archive; name fewer columns, and filter on them, to leave payloads packed."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(schema).option("path", path).load()
