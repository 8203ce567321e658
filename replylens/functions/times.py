"""Time-of-day and duration Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .text import col_of, strip

# H:M:S.fraction (the only form whose fraction is cut before parsing).
_FRACTION = r"^\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,9}$"


def _clock(s: Column, pattern: str) -> Column:
    return F.try_to_timestamp(s, F.lit(pattern))


def normalize_time(c) -> Column:
    """'H:M:S.f' (1-9 fraction digits), 'H:M:S' or 'H:M' -> 'HH:mm:ss' (fraction
    truncated); anything else (or out of range) -> null. Uses the datetime
    parser (range checks included); a regex only for the fraction form."""
    s = strip(col_of(c).cast("string"))
    whole = F.when(s.rlike(_FRACTION), F.substring_index(s, ".", 1)).otherwise(s)
    ts = F.coalesce(_clock(whole, "H:m:s"), F.when(~s.contains("."), _clock(s, "H:m")))
    return F.date_format(ts, "HH:mm:ss")


def coerce_hms(c) -> Column:
    """Strict 'H:M:S' below 24 h (history cells) -> 'HH:mm:ss'; else null."""
    return F.date_format(_clock(strip(col_of(c).cast("string")), "H:m:s"), "HH:mm:ss")


def hour_of(c) -> Column:
    """Hour of a strict 'H:M:S' text, else null."""
    return F.hour(_clock(strip(col_of(c).cast("string")), "H:m:s"))


def hms_to_seconds(c) -> Column:
    """'H:M:S' (hours unbounded) -> seconds; anything not three integers -> null."""
    parts = F.split(col_of(c).cast("string"), ":")
    h = F.try_element_at(parts, F.lit(1)).try_cast("bigint")
    m = F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    s = F.try_element_at(parts, F.lit(3)).try_cast("bigint")
    return F.when(F.size(parts) == 3, h * 3600 + m * 60 + s)


def seconds_to_hms(c) -> Column:
    """Non-negative seconds -> 'HH:MM:SS' with hours allowed past 99."""
    x = col_of(c).cast("bigint")
    return F.when(
        x.isNotNull() & (x >= 0),
        F.format_string("%02d:%02d:%02d", F.floor(x / 3600), F.floor((x % 3600) / 60), x % 60),
    )


def seconds_between(start_ts, end_ts) -> Column:
    """Whole seconds from ``start_ts`` to ``end_ts`` (TIMESTAMP_NTZ), sign kept."""
    return F.timestamp_diff("SECOND", col_of(start_ts), col_of(end_ts))


def empty_cell(c) -> Column:
    """Null, blank or an empty word such as 'nan'."""
    s = strip(col_of(c).cast("string"))
    return s.isNull() | (F.length(s) == 0) | F.lower(s).isin(S.EMPTY_WORDS)
