"""URL path, segments and their cleaning, following Python's lenient URL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions import bind

# Scheme and authority are optional; text without a scheme is all path.
PATH_PATTERN = r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*|[a-zA-Z][a-zA-Z0-9+.-]*:)?([^?#]*)"
PARAMS_PATTERN = r";[^/]*$"

# Identifiers and API prefixes that cannot be a title. The prefixes are plain text
# starts, so "apicultura" is rejected as well.
TECHNICAL_PATTERN = (
    r"^(?:[\p{Nd}a-f]{8}(?:-[\p{Nd}a-f]{4}){3}-[\p{Nd}a-f]{12}|[\p{Nd}a-f]{32}|api|v1|v2|\p{Nd}+$)"
)
EXTENSION_PATTERN = r"\.[\p{L}\p{N}_]+$"
MIN_TITLE_LENGTH = 5
_BLANKS = " \t\n\r\x0b\x0c"


def url_path(url: Column) -> Column:
    """Path of a URL without the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, PATH_PATTERN, 1), PARAMS_PATTERN, "")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and broken escapes as they are."""
    guarded = F.regexp_replace(text, "%(?![0-9a-fA-F]{2})", "%25")
    guarded = F.regexp_replace(guarded, r"\+", "%2B")
    return F.coalesce(F.try_url_decode(guarded), text)


def path_segments(url: Column) -> Column:
    """Non-empty path segments, decoded before the split so that ``%2F`` splits too."""
    def split(path: Column) -> Column:
        decoded = F.when(F.contains(path, F.lit("%")), percent_decode(path)).otherwise(path)
        return F.filter(F.split(decoded, "/"), lambda s: s != "")

    return bind(url_path(url), split)


def is_technical(segment: Column) -> Column:
    return segment.rlike(TECHNICAL_PATTERN)


def clean_segment(segment: Column) -> Column:
    """Separators to spaces, file extension dropped, blanks trimmed."""
    text = F.regexp_replace(segment, "[-_]+", " ")
    return F.btrim(F.regexp_replace(text, EXTENSION_PATTERN, ""), F.lit(_BLANKS))


def title_candidates(url: Column) -> Column:
    """Cleaned segments that are long enough and not technical, in path order."""
    kept = F.filter(path_segments(url), lambda s: ~is_technical(s))
    return F.filter(F.transform(kept, clean_segment), lambda s: F.length(s) >= MIN_TITLE_LENGTH)
