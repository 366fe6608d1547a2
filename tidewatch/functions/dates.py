"""Day parsing, ISO rendering and time-range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_LAST_SECOND = (1 << 63) // 1_000_000 - 1  # what a count of microseconds in 64 bits holds

Moment = str | dt.date | dt.datetime


def day_text(sqldate: Column) -> Column:
    """The eight characters of a day string that carry the date."""
    return F.substring(sqldate, 1, 8)


def parse_day(sqldate: Column) -> Column:
    """``yyyyMMdd`` text to a date, null when it is not one; trailing text is ignored."""
    return F.try_to_date(day_text(sqldate), "yyyyMMdd")


def parse_day_strict(sqldate: Column) -> Column:
    """``yyyyMMdd`` text to midnight of that day, null when there is anything else in it."""
    return F.try_to_date(sqldate, "yyyyMMdd").cast("timestamp")


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds to a timestamp; a value that the type cannot hold is null instead of an overflow."""
    return F.when(seconds.between(-_LAST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds))


def iso_millis(moment: Column) -> Column:
    return F.date_format(moment, ISO_MILLIS)


def iso_midnight(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'00:00:00.000'Z'")


def iso_plain(moment: Column) -> Column:
    """Zone-less ISO text whose fraction appears only when it is not zero."""
    text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def as_utc(moment: Moment) -> dt.datetime:
    """Python or ISO moment as naive UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    elif not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time())
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return moment


def timestamp_literal(moment: Moment) -> Column:
    """Constant that Catalyst folds, so comparisons with it reach the scan."""
    return F.lit(as_utc(moment).isoformat(sep=" ") + "Z").cast("timestamp")


def day_in_range(day: Column, start: Moment | None, end: Moment | None) -> Column | None:
    """Midnight of ``day`` within [start, end]; None unless both bounds are given.

    The bounds become dates here, so the predicate is a plain comparison on the
    stored date and prunes partitions.
    """
    if not (start and end):
        return None
    low, high = as_utc(start), as_utc(end)
    first = low.date() if low.time() == dt.time() else low.date() + dt.timedelta(days=1)
    return day.between(F.lit(first), F.lit(high.date()))


def moment_in_range(moment: Column, start: Moment | None, end: Moment | None) -> Column | None:
    """``moment`` within [start, end]; None unless both bounds are given."""
    if not (start and end):
        return None
    return moment.between(timestamp_literal(start), timestamp_literal(end))


def moment_in_open_range(moment: Column, start: Moment | None, end: Moment | None) -> Column | None:
    """``moment`` within (start, end]; None unless both bounds are given."""
    if not (start and end):
        return None
    return (moment > timestamp_literal(start)) & (moment <= timestamp_literal(end))


def relative_range(now: Moment, days: int = 30) -> tuple[dt.datetime, dt.datetime]:
    """The dashboard's "last n days" (7, 15 and 30 are its presets)."""
    end = as_utc(now)
    return end - dt.timedelta(days=days), end
