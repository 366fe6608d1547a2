"""Daily event files: headerless, tab-separated, fixed columns."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.schemas import CORRUPT_COLUMN, EVENT_SCHEMA, ddl, with_corrupt_column

# The feed does not quote fields; with the usual '"' a stray quote at the start of a
# field would swallow the tabs that follow.
NO_QUOTE = ""


def csv_options(quote: str = NO_QUOTE) -> dict[str, str]:
    return {"sep": "\t", "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_events(spark: SparkSession, paths: str | list[str], *, quote: str = NO_QUOTE,
                keep_corrupt: bool = False) -> DataFrame:
    """Any number of day files in one scan; malformed fields are null, never an error.

    ``keep_corrupt`` adds the text of malformed lines as ``_corrupt_record``.
    """
    schema = with_corrupt_column(EVENT_SCHEMA) if keep_corrupt else EVENT_SCHEMA
    return spark.read.schema(schema).options(**csv_options(quote)).csv(paths)


def parse_event_lines(df: DataFrame, line: str = "value", *, quote: str = NO_QUOTE,
                      keep_corrupt: bool = False) -> DataFrame:
    """The same parse over a text column.

    The parse sits in a generator because Catalyst copies a projected one into every
    filter on its fields, and would then parse each line several times.
    """
    schema = with_corrupt_column(EVENT_SCHEMA) if keep_corrupt else EVENT_SCHEMA
    return df.select(F.inline(F.array(F.from_csv(F.col(line), ddl(schema), csv_options(quote)))))


def with_audit(df: DataFrame) -> DataFrame:
    return df.withColumn("ProcessedDate", F.current_timestamp()).withColumn("ProcessingDate", F.current_date())


def with_event_date(events: DataFrame) -> DataFrame:
    """The typed day the event table is partitioned by."""
    return events.withColumn("event_date", dates.parse_day(F.col("SQLDATE")))


def reject_reason(has_corrupt: bool) -> Column:
    reason = F.when(F.col("event_date").isNull(), "bad_date")
    return reason.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed") if has_corrupt else reason


def routed(events: DataFrame) -> DataFrame:
    """Every row under the ``kind`` of table it belongs to, ``events`` or ``rejects``.

    A malformed line whose date is good stays an event, with nulls where its fields were
    bad, and is a reject as well: it becomes two rows, so one pass over the raw files can
    write both tables.
    """
    has_corrupt = CORRUPT_COLUMN in events.columns
    if not has_corrupt:
        events = events.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    reasoned = with_event_date(events).withColumn("reject_reason", reject_reason(has_corrupt))
    kinds = F.array_compact(F.array(
        F.when(F.col("event_date").isNotNull(), F.lit("events")),
        F.when(F.col("reject_reason").isNotNull(), F.lit("rejects")),
    ))
    rejected = F.col("kind") == "rejects"
    return reasoned.withColumn("kind", F.explode(kinds)).withColumns({
        name: F.when(rejected, F.col(name)) for name in (CORRUPT_COLUMN, "reject_reason")
    })


def split_rejects(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events that have a day, rejects with a ``reject_reason``)."""
    rows = routed(events)
    good = rows.where("kind = 'events'").drop("kind", CORRUPT_COLUMN, "reject_reason")
    return good, rows.where("kind = 'rejects'").drop("kind", "event_date")


def seen(observation: Observation, name: str = "rows", missing: int | None = 0) -> int | None:
    """A count taken by ``observe``; ``missing`` where the optimizer dropped the node, as no rows came of it.

    Reading such an observation raises an error of the JVM.
    """
    try:
        count = observation.get.get(name)
    except (Py4JJavaError, PySparkException):
        return missing
    return missing if count is None else count


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count taken while the rows stream by in whatever job runs next: no extra pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
