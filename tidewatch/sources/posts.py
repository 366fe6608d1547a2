"""Post archives: one JSON search result per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.normalize import normalize, union_posts
from tidewatch.schemas import CORRUPT_COLUMN, PLATFORMS, ddl, get_schema, with_corrupt_column


JSON_OPTIONS = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_envelopes(spark: SparkSession, paths: str | list[str], platform: str, *,
                   keep_corrupt: bool = False) -> DataFrame:
    """One row per file whose path contains the platform's name, with ``file_name``.

    A file is one record and one unit of work; the search that produced it caps its size.
    The condition on the path drops other files before they are opened.
    """
    schema = get_schema(platform)
    if keep_corrupt:
        schema = with_corrupt_column(schema)
    return of_platform(spark.read.schema(schema).options(**JSON_OPTIONS).json(paths), platform)


def stream_envelopes(spark: SparkSession, folder: str, platform: str, files_per_batch: int) -> DataFrame:
    """The same rows from files as they arrive, broken files included."""
    stream = spark.readStream.schema(with_corrupt_column(get_schema(platform))).options(**JSON_OPTIONS)
    return of_platform(stream.option("maxFilesPerTrigger", files_per_batch).json(folder), platform)


def of_platform(files: DataFrame, platform: str) -> DataFrame:
    """Files with the platform's name anywhere in their path, in any case."""
    return files.where(F.contains(F.lower("_metadata.file_path"), F.lit(platform.lower()))).withColumns(
        {"file_name": F.col("_metadata.file_name"), "file_path": F.col("_metadata.file_path")})


def broken_files(envelopes: DataFrame) -> DataFrame:
    """Files that are no whole JSON result, with their text and the number of hits read from them all the same."""
    return envelopes.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        "file_name", "file_path", CORRUPT_COLUMN, announced_and_held(envelopes)[1].alias("held_hits"), *(c for c in ("load",) if c in envelopes.columns))


def parse_envelopes(df: DataFrame, platform: str, json: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The same parse over a text column, next to the columns to ``keep``.

    It sits in a generator so that each text is parsed once.
    """
    parsed = F.from_json(F.col(json), ddl(get_schema(platform)), {"mode": "PERMISSIVE"})
    return df.select(*(keep or []), F.inline(F.array(parsed)))


def unnest_hits(envelopes: DataFrame, *keep: str) -> DataFrame:
    """One row per hit with the fields of its source; an envelope without hits gives none.

    ``keep`` names columns of the envelope that go along.
    """
    return envelopes.select(*keep, F.explode("hits.hits._source").alias("source")).select(*keep, "source.*")


def hit_counts(envelopes: DataFrame) -> DataFrame:
    """Hits a file announces next to the hits it holds: fewer held means a truncated result."""
    total, held = announced_and_held(envelopes)
    return envelopes.select(
        "file_name", total.alias("total_hits"), held.alias("held_hits"), (total > held).alias("truncated")
    )


def announced_and_held(envelopes: DataFrame) -> tuple[Column, Column]:
    has_total = "total" in envelopes.schema["hits"].dataType.fieldNames()
    total = F.col("hits.total.value") if has_total else F.lit(None).cast("long")
    return total, F.coalesce(F.size("hits.hits"), F.lit(0))


def read_posts(spark: SparkSession, paths: str | list[str], platforms: list[str] | tuple[str, ...] = PLATFORMS,
               *, options: dict[str, dict] | None = None) -> DataFrame:
    """Common posts of all given platforms; ``options`` go to each platform's normaliser."""
    options = options or {}
    return union_posts(*(
        normalize(unnest_hits(read_envelopes(spark, paths, p)), p, **options.get(p.lower(), {}))
        for p in platforms
    ))
