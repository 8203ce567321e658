"""Text Column builders: whitespace, names, titles, accents, flags, previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.isspace() accepts (what str.strip() removes).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c) -> Column:
    """Remove leading/trailing Unicode whitespace (``F.trim`` alone only removes
    spaces); a character-set trim, no regex."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def fix_spaces(c) -> Column:
    """No-break and narrow no-break spaces become plain spaces."""
    return F.translate(col_of(c), S.NBSP_CHARS, " " * len(S.NBSP_CHARS))


def norm_name(c) -> Column:
    """Collapse every whitespace run (NBSP included) to one space, trim, lower-case."""
    return F.lower(F.trim(F.regexp_replace(col_of(c), r"(?U)\s+", " ")))


# Titles of the chat list use the same rule as author names.
norm_title = norm_name


def fold_accents(c) -> Column:
    """Lower-case and drop accents: composed letters of schema.ACCENTED, and combining
    marks of decomposed text."""
    return F.regexp_replace(F.translate(F.lower(col_of(c)), S.ACCENTED, S.PLAIN), r"\p{Mn}+", "")


def is_valid_title(c, reserved=None, max_len: int = S.MAX_TITLE_LEN) -> Column:
    """Chat-list title usable as a chat: non-empty, one line, short, not a reserved folder."""
    reserved = list(S.RESERVED_TITLES if reserved is None else reserved)
    t = strip(c)
    return (
        t.isNotNull()
        & (F.length(t) > 0)
        & ~t.contains("\n")
        & (F.length(t) <= max_len)
        & ~t.isin(reserved)
    )


def yes_flag(c) -> Column:
    """'SI'/'si' -> true, 'NO'/'no' -> false, anything else -> null."""
    u = F.upper(strip(col_of(c)))
    return F.when(u == S.FLAG_YES, F.lit(True)).when(u == S.FLAG_NO, F.lit(False))


def flag_text(c) -> Column:
    """Boolean flag back to the 'SI'/'NO' text of lead files."""
    return F.when(col_of(c), F.lit(S.FLAG_YES)).when(~col_of(c), F.lit(S.FLAG_NO))


def safe_name(c, default: str = S.DEFAULT_EXPORT_NAME) -> Column:
    """Keep letters, digits, space, '_' and '-'; trim; spaces to '-'; empty -> default."""
    kept = F.trim(F.regexp_replace(col_of(c), r"[^\p{L}\p{N} _-]", ""))
    dashed = F.regexp_replace(kept, " ", "-")
    return F.when(F.length(dashed) > 0, dashed).otherwise(F.lit(default))


def preview(c, n: int = S.PREVIEW_CHARS) -> Column:
    """Trimmed text, newlines to spaces, first ``n`` characters."""
    return F.substring(F.translate(strip(col_of(c)), "\n", " "), 1, n)


def media_text(text, kind) -> Column:
    """Message text, or the media placeholder when the message has no text."""
    t = strip(col_of(text))
    k = col_of(kind)
    return (
        F.when(F.coalesce(F.length(t), F.lit(0)) > 0, t)
        .when(k == "AUDIO", F.lit(S.MEDIA_AUDIO))
        .when(k == "ADJUNTO", F.lit(S.MEDIA_ATTACHMENT))
        .otherwise(F.lit(""))
    )


def classify_shift(c) -> Column:
    """Shift keyword of a sheet cell: 'tarde' wins, then 'mañana'/'manana'; else null."""
    raw = F.lower(strip(col_of(c)))
    plain = fold_accents(raw)
    return (
        F.when(plain.contains(S.SHIFT_AFTERNOON), F.lit(S.SHIFT_AFTERNOON))
        .when(plain.contains(S.SHIFT_MORNING_PLAIN) | raw.contains(S.SHIFT_MORNING), F.lit(S.SHIFT_MORNING))
    )


def null_if_token(c, tokens=None) -> Column:
    """Cells equal to a missing-value token become null (read-side NA handling)."""
    tokens = list(S.NA_TOKENS if tokens is None else tokens)
    x = col_of(c)
    return F.when(x.isin(tokens), F.lit(None).cast("string")).otherwise(x)


def canonical_id(c) -> Column:
    """Lead id as trimmed text; a numeric id written as '123.0' becomes '123'."""
    t = strip(col_of(c).cast("string"))
    t = F.regexp_replace(t, r"^(-?\d+)\.0+$", "$1")
    return F.when(F.length(t) > 0, t)
