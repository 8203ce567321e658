"""Date Column builders: relative words, multi-format parsing, dates inside text."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .text import col_of, strip


def _as_date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def resolve_relative(c, as_of) -> Column:
    """'hoy' -> as_of and 'ayer' -> as_of - 1 day (ISO text); other text unchanged."""
    s = strip(col_of(c).cast("string"))
    low = F.lower(s)
    day = _as_date(as_of)
    return (
        F.when(low == S.TODAY_WORD, F.lit(day.isoformat()))
        .when(low == S.YESTERDAY_WORD, F.lit((day - _dt.timedelta(days=1)).isoformat()))
        .otherwise(s)
    )


def normalize_date(c, as_of=None, strict: bool = False) -> Column:
    """Parse a free-form date cell into a DATE (invalid or empty -> null).

    Lenient (``strict=False``): relative words when ``as_of`` is given,
    ``d/m/yyyy`` with one- or two-digit fields, ISO date, ISO date-time
    (time dropped). Strict: no relative words and ``dd/mm/yyyy`` needs two
    digits per field.
    """
    s = strip(col_of(c).cast("string"))
    if as_of is not None and not strict:
        s = resolve_relative(s, as_of)
    dmy = S.DMY_STRICT if strict else S.DMY_LENIENT
    one_space = F.regexp_replace(s, r"\s+", " ")
    return (
        F.when(s.rlike(dmy), F.try_to_date(s, "d/M/yyyy"))
        .when(s.rlike(S.ISO_DATE), F.try_to_date(s, "yyyy-MM-dd"))
        .when(s.rlike(S.ISO_DATETIME),
              F.to_date(F.try_to_timestamp(one_space, F.lit("yyyy-MM-dd HH:mm:ss"))))
    )


def coerce_iso_date(c) -> Column:
    """History cells: only ``yyyy-m-d`` text is a date, anything else null."""
    s = strip(col_of(c).cast("string"))
    return F.when(s.rlike(S.ISO_DATE_LOOSE), F.try_to_date(s, "yyyy-M-d"))


def sheet_date(c) -> Column:
    """Schedule cell date: ISO date, ISO date-time or d/m/yyyy; else null."""
    s = strip(col_of(c).cast("string"))
    return (
        F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(s, "yyyy-M-d"))
        .when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2})?$"),
              F.to_date(F.coalesce(
                  F.try_to_timestamp(F.regexp_replace(s, "T", " "), F.lit("yyyy-M-d H:mm:ss")),
                  F.try_to_timestamp(F.regexp_replace(s, "T", " "), F.lit("yyyy-M-d H:mm")))))
        .when(s.rlike(S.DMY_LENIENT), F.try_to_date(s, "d/M/yyyy"))
    )


def date_in_text(c) -> Column:
    """First ``d/m/yy`` or ``d/m/yyyy`` inside the text as a DATE (yy -> 20yy)."""
    x = col_of(c)
    d = F.regexp_extract(x, S.DATE_IN_TEXT_PATTERN, 1)
    m = F.regexp_extract(x, S.DATE_IN_TEXT_PATTERN, 2)
    y = F.regexp_extract(x, S.DATE_IN_TEXT_PATTERN, 3)
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    ts = F.try_make_timestamp_ntz(
        years=year.cast("int"), months=m.cast("int"), days=d.cast("int"),
        hours=F.lit(0), mins=F.lit(0), secs=F.lit(0),
    )
    return F.when(x.rlike(S.DATE_IN_TEXT_PATTERN), F.to_date(ts))


def combine(date_col, time_col) -> Column:
    """DATE + 'HH:mm:ss' text -> TIMESTAMP_NTZ; invalid or missing part -> null."""
    d = col_of(date_col).cast("string")
    t = strip(col_of(time_col))
    return F.try_to_timestamp(F.concat_ws(" ", d, t), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def time_text(ts) -> Column:
    """'HH:mm:ss' of a timestamp (fraction truncated)."""
    return F.date_format(col_of(ts), "HH:mm:ss")
