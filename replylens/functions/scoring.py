"""Response-time score and hour-of-day segment Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .text import col_of
from .times import hour_of


def score_code(seconds, buckets=None) -> Column:
    """Bucket code of a response time in seconds (null in -> null out)."""
    buckets = S.SCORE_BUCKETS if buckets is None else buckets
    x = col_of(seconds)
    first_code, _, first_bound = buckets[0]
    expr = F.when(x.isNull(), F.lit(None).cast("string")).when(F.abs(x) < first_bound, F.lit(first_code))
    for code, _, bound in buckets[1:]:
        expr = expr.when(x <= bound, F.lit(code)) if bound is not None else expr.otherwise(F.lit(code))
    return expr


def segment_code(time_text) -> Column:
    """Segment code of an 'HH:mm:ss' inbound time; unparsable -> null."""
    h = hour_of(time_text)
    expr = F.when(h.isNull(), F.lit(None).cast("string"))
    for code, _, upper in S.SEGMENTS:
        expr = expr.when(h < upper, F.lit(code))
    return expr


def _label_map(pairs) -> Column:
    flat = []
    for code, label in pairs:
        flat += [F.lit(code), F.lit(label)]
    return F.create_map(*flat)


def _mapped(x, pairs) -> Column:
    """The pair's second value; a value that is in no pair passes through unchanged."""
    return F.coalesce(F.try_element_at(_label_map(pairs), x), x)


def score_label(code) -> Column:
    """Display label (with emoji) of a score code; a foreign value is its own label."""
    pairs = [(c, l) for c, l, _ in S.SCORE_BUCKETS] + [S.SCORE_OUTBOUND, S.SCORE_NOT_ANSWERED]
    return _mapped(col_of(code), pairs)


def segment_label(code) -> Column:
    pairs = [(c, l) for c, l, _ in S.SEGMENTS] + [S.SEGMENT_NOT_REGISTERED]
    return _mapped(col_of(code), pairs)


def score_from_label(label) -> Column:
    """Score code of a display label or of a code (history files carry labels); a
    foreign label is kept as it is."""
    pairs = [(c, l) for c, l, _ in S.SCORE_BUCKETS] + [S.SCORE_OUTBOUND, S.SCORE_NOT_ANSWERED]
    return _mapped(F.nullif(F.trim(col_of(label)), F.lit("")), [(l, c) for c, l in pairs])


def segment_from_label(label) -> Column:
    pairs = [(c, l) for c, l, _ in S.SEGMENTS] + [S.SEGMENT_NOT_REGISTERED]
    return _mapped(F.nullif(F.trim(col_of(label)), F.lit("")), [(l, c) for c, l in pairs])
