"""Which files a time range needs; fetching them is not Spark's work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_DAYS = 3


def daily_file_plan(bounds: DataFrame) -> DataFrame:
    """One row per day of each ``(start, end)`` row, both included: ``day, file_name``."""
    days = F.when(
        F.to_date("start") <= F.to_date("end"),
        F.sequence(F.to_date("start"), F.to_date("end"), F.expr("interval 1 day")),
    )
    others = [c for c in bounds.columns if c not in ("start", "end")]
    return bounds.select(*others, F.explode(days).alias("day")).withColumn(
        "file_name", F.concat(F.date_format("day", "yyyyMMdd"), F.lit(".export.CSV"))
    )


def missing_files(plan: DataFrame, present: DataFrame) -> DataFrame:
    """Planned files that are not among the ``file_name`` of ``present``."""
    return plan.join(present.select("file_name"), "file_name", "left_anti")


def window_file_plan(bounds: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Consecutive windows of each ``(Platform, start, end)`` row; the last is cut at ``end``.

    A window's end is the next one's start, and names carry days only, so neighbouring
    files share a day.
    """
    starts = F.when(
        F.col("start") < F.col("end"),
        F.sequence(F.col("start"), F.col("end") - F.expr("interval 1 microsecond"), F.expr(f"interval {days} days")),
    )
    return (
        bounds.select("Platform", "end", F.explode(starts).alias("window_start"))
        .withColumn("window_end", F.least(F.col("window_start") + F.expr(f"interval {days} days"), F.col("end")))
        .withColumn("file_name", F.format_string(
            "%s_%s_%s.json", "Platform",
            F.date_format("window_start", "yyyyMMdd"), F.date_format("window_end", "yyyyMMdd"),
        ))
        .drop("end")
    )
