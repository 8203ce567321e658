"""Chat-export meta parsing: '[h:mm am/pm, n/n/yyyy] author:' -> time, author, timestamp.

One regex pass per row: the matched prefix is rewritten into its groups joined
by a control character and split into an array. Intermediate values are bound
with ``transform(array(x), v -> ...)`` so each is computed once; the
expression stays linear in size even where the optimizer inlines it (for
example into a pushed-down filter), and whole-stage codegen stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .text import col_of, fix_spaces, strip

_SEP = "\u0001"
_GROUPS = 7


def bind(value: Column, fn) -> Column:
    """``fn(v)`` with ``v`` bound to ``value`` once (a one-element lambda map)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def meta_groups(c) -> Column:
    """Array [marker, g1..g7] of the meta prefix groups; a one-element array when
    the text does not match."""
    rewrite = "".join(f"{_SEP}${i}" for i in range(1, _GROUPS + 1))
    return F.split(F.regexp_replace(strip(fix_spaces(col_of(c))), "(?s)" + S.META_PATTERN + ".*", rewrite), _SEP)


def parse_meta(c, strict_ampm: bool = False) -> Column:
    """Struct(dt TIMESTAMP_NTZ at minute precision, author) of a meta cell.

    Day/month order: first > 12 means day/month, else second > 12 means
    month/day, else day/month. With am/pm the hour must be 1-12. ``dt`` is
    null when the text does not match or the values are out of range; the
    author is kept even then.
    """

    def from_groups(g):
        ok = F.size(g) == _GROUPS + 1

        def part(i):
            return F.when(ok, F.element_at(g, i + 1))

        ampm = F.lower(F.regexp_replace(part(3), r"(?U)\s+", ""))
        if strict_ampm:
            is_am, is_pm = ampm.isin("am", "a.m", "a.m."), ampm.isin("pm", "p.m", "p.m.")
        else:
            is_am, is_pm = ampm.startswith("a"), ampm.startswith("p")
        vals = F.struct(
            ok.alias("ok"), part(1).try_cast("int").alias("h"), part(2).try_cast("int").alias("mi"),
            (is_am | is_pm).alias("twelve"), is_pm.alias("pm"), part(4).try_cast("int").alias("a"),
            part(5).try_cast("int").alias("b"), part(6).try_cast("int").alias("y"), strip(part(7)).alias("author"))
        return bind(vals, from_values)

    def from_values(v):
        h, a, b = v["h"], v["a"], v["b"]
        hour = (F.when(v["twelve"] & h.between(1, 12), h % 12 + F.when(v["pm"], 12).otherwise(0))
                .when(~v["twelve"], h))
        day = F.when(a > 12, a).when(b > 12, b).otherwise(a)
        month = F.when(a > 12, b).when(b > 12, a).otherwise(b)
        good = (v["ok"] & month.between(1, 12) & day.between(1, 31) & (v["mi"] <= 59) & (hour <= 23))
        dt = F.when(good, F.try_make_timestamp_ntz(years=v["y"], months=month, days=day, hours=hour,
                                                   mins=v["mi"], secs=F.lit(0)))
        author = F.when(v["ok"] & (F.length(v["author"]) > 0), v["author"])
        return F.struct(dt.cast("timestamp_ntz").alias("dt"), author.alias("author"))

    return bind(meta_groups(c), from_groups)


def with_parsed_meta(df: DataFrame, meta_col: str = "meta", strict_ampm: bool = False,
                     keep_unparsed: bool = False) -> DataFrame:
    """Add ``dt``, ``msg_time`` ('HH:mm:00') and ``author`` parsed from ``meta_col``.

    Rows without a valid timestamp are dropped unless ``keep_unparsed``; the
    drop is a generator over a filtered one-element array, so the parse runs
    once per row (a plain filter would be pushed below the projection and
    parse every row twice).
    """
    cols = [c for c in df.columns if c not in ("dt", "msg_time", "author")]
    parsed = F.array(parse_meta(F.col(meta_col), strict_ampm))
    if not keep_unparsed:
        parsed = F.filter(parsed, lambda p: p["dt"].isNotNull())
    out = df.select(*cols, F.inline(parsed))
    return out.withColumn("msg_time", F.date_format(F.col("dt"), "HH:mm:ss"))
