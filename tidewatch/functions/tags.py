"""Hashtag arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named_tags(names: Column, *, null_as_empty: bool = False) -> Column:
    """Tags that arrive as an array of names; a missing array stays null by default."""
    return F.coalesce(names, F.array().cast("array<string>")) if null_as_empty else names


def text_tags(text: Column, *, strip_hash: bool = False) -> Column:
    """Distinct words that start with ``#``, split on the space character only."""
    found = F.filter(F.split(text, " "), lambda w: F.startswith(w, F.lit("#")))
    if strip_hash:
        found = F.transform(found, lambda w: F.substring(w, 2, 2147483647))
    return F.array_distinct(found)
