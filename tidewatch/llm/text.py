"""Texts inside tasks: slices of bounded size, word spans and word hashes over whole slices at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.session import CORE_CONF

SLICE_BYTES = 1 << 18
# Rows with texts can be large: a task should hold few of them at once.
SETTINGS = {key: CORE_CONF[key] for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")} | {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def settings(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text, null as empty, and nothing else of the documents."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def whole_rows(docs: DataFrame, **more: F.Column) -> DataFrame:
    """All columns in one, so that no name of theirs meets ours, and the text, null as empty."""
    return docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"),
                       *(column.alias(name) for name, column in more.items()))


def unpacked(rows: pa.Array, schema: StructType, new_text: pa.Array | None = None) -> pa.RecordBatch:
    """The columns of the documents again, with another text and its length where one is given."""
    columns = dict(zip((f.name for f in rows.type), rows.flatten()))
    if new_text is not None:
        columns["text"] = new_text
        if "n_chars" in columns:
            columns["n_chars"] = pc.utf8_length(new_text).cast(columns["n_chars"].type)
    return pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of the batches in order, cut so that the texts of a slice hold about ``SLICE_BYTES``.

    A single longer text makes a slice of its own, so memory follows the longest text and not the batch.
    """
    for batch in batches:
        data = batch.column(column).cast(pa.binary())
        sizes = np.asarray(pc.binary_length(data).fill_null(0))
        ends = np.cumsum(sizes, dtype=np.int64)
        at, rows = 0, batch.num_rows
        while at < rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(at, to - at), [x or b"" for x in data.slice(at, to - at).to_pylist()]
            at = to


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with a space after each, and where each begins (one more entry: the end)."""
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    begins = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in parts], out=begins[1:])
    return data, begins


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all their bits (the finaliser of a well-known mixer)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class PrefixHash:
    """64-bit hashes of any stretch of an array of symbols, from one pass of prefix sums modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _powers = np.ones(1, dtype=np.uint64)
    _inverse = np.ones(1, dtype=np.uint64)

    @classmethod
    def _need(cls, n: int) -> None:
        if len(cls._powers) < n:
            size = 1 << (n - 1).bit_length()
            step = np.full(size, cls.BASE, dtype=np.uint64)
            step[0] = 1
            cls._powers = np.cumprod(step, dtype=np.uint64)
            step[1:] = pow(cls.BASE, -1, 1 << 64)
            cls._inverse = np.cumprod(step, dtype=np.uint64)

    def __init__(self, symbols: np.ndarray) -> None:
        self._need(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * self._powers[:len(symbols)], out=self.sums[1:], dtype=np.uint64)

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[begins]) * self._inverse[begins])


class SecondHash(PrefixHash):
    """An independent hash: both together have 128 bits."""

    BASE = 0xD1B54A32D192ED03
    _powers = np.ones(1, dtype=np.uint64)
    _inverse = np.ones(1, dtype=np.uint64)


def by_two_hashes(symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return PrefixHash(symbols).of(begins, ends), SecondHash(symbols).of(begins, ends)


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(PrefixHash.BASE))

# Bytes of words for the models: letters a-z after lower-casing, and everything beyond ASCII.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
