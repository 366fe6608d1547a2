"""Parquet tables: append, replace, upsert, and the status each write leaves."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import dates
from tidewatch.sinks.publish import publish, staged_folder
from tidewatch.sources.events import counted, seen


class Status(NamedTuple):
    table: str
    rows: int
    ok: bool
    error: str | None = None


STATUS_SCHEMA = "table string, rows long, ok boolean, error string"


def place_order(lat: str, long: str, bits: int = 16) -> Column:
    """The Morton number of a coordinate pair: rows that are near in both coordinates are near in this order.

    Each coordinate becomes a number of ``bits`` bits, and the bits of both alternate. Null and non-finite ones come first.
    """
    def spread(column: str, low: float, high: float) -> Column:
        share = (F.col(column).cast("double") - low) / (high - low)
        cell = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * ((1 << bits) - 1))
        number = F.when(F.col(column).isNotNull() & ~F.isnan(column), cell).cast("long")
        # Halve the groups of bits and move the halves apart, until single bits are left.
        width = 16
        while width:
            mask = sum(((1 << width) - 1) << at for at in range(0, 62, 2 * width))
            number = number.bitwiseOR(F.shiftleft(number, width)).bitwiseAND(F.lit(mask).cast("long"))
            width //= 2
        return number

    return spread(lat, -90, 90).bitwiseOR(F.shiftleft(spread(long, -180, 180), 1))


def append_rows(df: DataFrame, path: str, partition_by: list[str], *, sort_by: list[str | Column] | None = None,
                find_by: list[str] | None = None, rows_per_file: int = 0, group_bytes: int = 0) -> int:
    """Append to a partitioned table and return the number of rows written.

    Rows are rebalanced by partition first: files come out at the advisory size, small
    partitions are merged and one that holds much of the data is split over many tasks.
    Columns of ``find_by`` get Bloom filters, by which a reader skips row groups that lack a value.
    """
    balanced = df.hint("rebalance", *(F.col(c) for c in partition_by))
    if sort_by:
        balanced = balanced.sortWithinPartitions(*partition_by, *sort_by)
    # Counted above the shuffle, where a repeated task does not count twice.
    balanced, rows = counted(balanced, "append")
    writer = balanced.write.mode("append").partitionBy(*partition_by)
    for column in find_by or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return seen(rows)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Overwrite only the partitions ``df`` has rows for, so that a repeated load changes nothing."""
    df, rows = counted(df.hint("rebalance", *(F.col(c) for c in partition_by)), "replace")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))
    return seen(rows)


def replace_loads(df: DataFrame | None, path: str, partition_by: list[str], loads: list[str], *, spark: SparkSession,
                  sort_by: list[str | Column] | None = None, find_by: list[str] | None = None) -> int:
    """Append the rows and remove what the ``load`` partitions of these names held before, once the new rows are complete.

    ``partition_by`` begins with a kind and ``load``. Unlike a dynamic overwrite this also removes days and kinds that the
    new rows no longer have. A write that fails leaves the table as it was; no frame at all only removes.
    """
    files, staged = staged_folder(spark, path)
    try:
        rows = 0 if df is None else append_rows(
            df, f"{files.root}/{staged}", partition_by, sort_by=sort_by, find_by=find_by)
        new = {f"{kind}/{load}" for kind in files.folders(staged) for load in files.folders(f"{staged}/{kind}") if "=" in load}
        kinds = [kind for kind in files.folders() if kind.startswith(f"{partition_by[0]}=")]
        old = {f"{kind}/load={load}" for kind in kinds for load in loads if files.exists(f"{kind}/load={load}")}
    except Exception:
        files.remove(staged)
        raise
    if new | old:
        publish(files, staged, [(place, place in new) for place in sorted(new | old)])
    files.remove(staged)
    return rows


def replace_days(df: DataFrame, path: str, column: str, days: list[str]) -> int:
    """Make ``df`` all that the partitions of these days hold; those it has no rows for go."""
    files, staged = staged_folder(df.sparkSession, path)
    try:
        rows = append_rows(df, f"{files.root}/{staged}", [column])
        new = {f for f in files.folders(staged) if "=" in f}
        old = {f"{column}={day}" for day in days if files.exists(f"{column}={day}")}
    except Exception:
        files.remove(staged)
        raise
    if new | old:
        publish(files, staged, [(place, place in new) for place in sorted(new | old)])
    files.remove(staged)
    return rows


def replace_table(df: DataFrame, path: str, *, sort_by: list[str | Column] | None = None) -> int:
    """Replace a derived table; sorted files let a reader skip row groups by min and max.

    The old rows stay readable until the new ones are complete, so a table may also be computed from itself.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    parent, _, name = path.rstrip("/").rpartition("/")
    files, staged = staged_folder(df.sparkSession, parent or ".")
    df, rows = counted(df, "table")
    try:
        df.write.parquet(f"{files.root}/{staged}/{name}")
    except Exception:
        files.remove(staged)
        raise
    publish(files, staged, [(name, True)])
    return seen(rows)


def write_status(table: str, write: Callable[[], int], *, empty_ok: bool = False) -> Status:
    """Run one write; an empty result or a Spark error makes the table fail, not the run."""
    try:
        rows = write()
    except PySparkException as error:
        return Status(table, 0, False, str(error).splitlines()[0])
    return Status(table, rows, empty_ok or rows > 0)


def status_frame(spark: SparkSession, statuses: list[Status]) -> DataFrame:
    return spark.createDataFrame(statuses, STATUS_SCHEMA)


def to_documents(df: DataFrame, *, keep_nulls: bool) -> DataFrame:
    """One JSON document per row in ``document``; times as ISO text, nulls kept or dropped."""
    columns = [
        (dates.iso_plain(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name))
        for f in df.schema.fields
    ]
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*columns), options).alias("document"))
