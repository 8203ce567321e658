"""Lead consolidation and scoring: align -> union -> dedupe -> response -> score -> segment.

Everything is one lazy plan of narrow expressions plus a single shuffle (the
dedupe on ``lead_id``). The dedupe is a ``min(struct(rank keys, row))``
aggregate, not a ranked window: it is partially aggregated map-side, so a lead
id repeated in a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import (strip, canonical_id, coerce_hms, coerce_iso_date, combine, empty_cell, hms_to_seconds,
                         normalize_date, normalize_time, score_code, score_from_label, segment_code,
                         segment_from_label, seconds_between, seconds_to_hms, yes_flag)
from .joins import bounded_broadcast

CANONICAL = [f.name for f in S.LEAD_SCHEMA.fields]
_TYPES = {f.name: f.dataType for f in S.LEAD_SCHEMA.fields}


def rename_headers(df: DataFrame, mapping=None) -> DataFrame:
    """File headers -> canonical names (unknown headers kept as they are)."""
    mapping = S.LEAD_HEADERS if mapping is None else mapping
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def align_to(df: DataFrame, columns: list[str], types: dict | None = None) -> DataFrame:
    """Same columns as the base, in its order: copy existing, null-fill missing, drop extra."""
    types = types or {}
    return df.select(*[
        F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
        for c in columns
    ])


def select_wanted(df: DataFrame) -> DataFrame | None:
    """Keep the wanted lead columns present in a new file (None when there is none);
    create ``ID_LEAD`` from ``lead_id`` when the ``ID_LEAD`` column is missing."""
    present = [c for c in S.NEW_LEAD_HEADERS if c in df.columns]
    if not present:
        return None
    lineage = [c for c in ("source_file",) if c in df.columns]
    out = df.select(*present, *lineage)
    if "ID_LEAD" not in out.columns and S.ALT_LEAD_ID_HEADER in out.columns:
        out = out.withColumn("ID_LEAD", F.col(S.ALT_LEAD_ID_HEADER))
    return out.drop(S.ALT_LEAD_ID_HEADER)


def raw_new_leads(frames) -> DataFrame | None:
    """New lead files (Spanish headers, text cells, any layout) -> one raw text frame
    in canonical names; files without any wanted column are skipped."""
    out = None
    for df in ([frames] if isinstance(frames, DataFrame) else frames):
        wanted = select_wanted(df) if df is not None else None
        if wanted is None:
            continue
        d = rename_headers(wanted)
        d = align_to(d, [c for c in CANONICAL[:8]] + ["source_file"])
        out = d if out is None else out.unionByName(d)
    return out


def empty_leads(spark) -> DataFrame:
    """No lead rows, in the canonical columns and types."""
    return spark.createDataFrame([], S.LEAD_SCHEMA)


def prepare_new_leads(df, as_of, source_rank: int = 1) -> DataFrame | None:
    """New lead files (one frame or a list; Spanish headers, all text) -> canonical
    typed rows (None when no frame has a wanted column). The layouts are unioned as text first, so the parsing
    expressions are built and run once. Dates are parsed leniently (relative
    words resolved against ``as_of``); times are normalised after the union
    with the history."""
    d = raw_new_leads(df)
    if d is None:
        return None
    # Clean text once in its own projection; the parsers below read it many times.
    d = d.select(*[strip(F.col(c).cast("string")).alias(c) for c in d.columns])
    out = d.select(
        F.col("executive").alias("executive"),
        canonical_id(F.col("lead_id")).alias("lead_id"),
        yes_flag(F.col("has_inbound")).alias("has_inbound"),
        yes_flag(F.col("has_outbound")).alias("has_outbound"),
        normalize_date(F.col("in_date"), as_of).alias("in_date"),
        F.col("in_time").alias("in_time"),
        normalize_date(F.col("out_date"), as_of).alias("out_date"),
        F.col("out_time").alias("out_time"),
        F.col("source_file").alias("source_file"),
    ).withColumn("source_rank", F.lit(source_rank))
    return align_to(out, CANONICAL, _TYPES)


def coerce_history(df: DataFrame) -> DataFrame:
    """History snapshot (canonical names, text cells) -> typed rows. Only ISO dates
    and 'H:M:S' times below 24 h survive; labels become codes (a foreign label
    stays as it is); a column the history lacks is null. The history's own further columns are kept as text, after the
    known ones: the history decides which columns a run writes."""
    d = rename_headers(df)
    d = d.withColumns({c: F.lit(None).cast("string") for c in CANONICAL[:8] if c not in d.columns})
    own = [c for c in d.columns if c not in CANONICAL and c != S.ALT_LEAD_ID_HEADER and not c.startswith("_")]
    d = d.select(*[strip(F.col(f"`{c}`").cast("string")).alias(c) for c in d.columns])
    out = d.select(
        F.col("executive").cast("string").alias("executive"),
        canonical_id(F.col("lead_id")).alias("lead_id"),
        yes_flag(F.col("has_inbound")).alias("has_inbound"),
        yes_flag(F.col("has_outbound")).alias("has_outbound"),
        coerce_iso_date(F.col("in_date")).alias("in_date"),
        coerce_hms(F.col("in_time")).alias("in_time"),
        coerce_iso_date(F.col("out_date")).alias("out_date"),
        coerce_hms(F.col("out_time")).alias("out_time"),
        (coerce_hms(F.col("response_time")) if "response_time" in d.columns else F.lit(None).cast("string")).alias("response_time"),
        (score_from_label(F.col("score")) if "score" in d.columns else F.lit(None).cast("string")).alias("score"),
        (segment_from_label(F.col("entry_segment")) if "entry_segment" in d.columns else F.lit(None).cast("string")).alias("entry_segment"),
        F.lit(0).alias("source_rank"),
        (F.col("source_file") if "source_file" in d.columns else F.lit(None).cast("string")).alias("source_file"),
        *[F.col(f"`{c}`") for c in own],
    )
    return align_to(out, CANONICAL + own, _TYPES)


def consolidate(history: DataFrame, new_rows: list[DataFrame] | DataFrame | None) -> DataFrame:
    """History plus every prepared new-lead frame, in the history's column order."""
    if new_rows is None:
        return history
    frames = new_rows if isinstance(new_rows, list) else [new_rows]
    out = history
    for f in frames:
        if f is not None:
            out = out.unionByName(align_to(f, history.columns, _TYPES), allowMissingColumns=False)
    return out


def normalize_lead_times(df: DataFrame) -> DataFrame:
    return df.withColumn("in_time", normalize_time(F.col("in_time"))).withColumn(
        "out_time", normalize_time(F.col("out_time")))


def rank_key(keep: str = "history_first"):
    """Order that decides which row of a lead is kept (smallest wins).

    ``history_first`` reproduces the export order: executive, then rows with
    an inbound date, history before new files, then the dates/times
    ascending with missing values last, then the source file.
    ``latest_answer`` prefers answered rows, latest reply first.
    """
    c = F.col
    if keep == "history_first":
        parts = [
            c("executive").isNull(), c("executive"),
            c("in_date").isNull(), c("source_rank"), c("in_date"),
            c("in_time").isNull(), c("in_time"),
            c("out_date").isNull(), c("out_date"),
            c("out_time").isNull(), c("out_time"),
            c("source_file").isNull(), c("source_file"),
        ]
    elif keep == "latest_answer":
        parts = [
            c("out_date").isNull(), F.datediff(F.lit("2999-12-31"), c("out_date")),
            c("out_time").isNull(), F.translate(c("out_time"), "0123456789", "9876543210"),
            c("source_rank"), c("executive"),
        ]
    else:
        raise ValueError(f"unknown keep {keep!r}")
    return F.struct(*[p.alias(f"r{i}") for i, p in enumerate(parts)])


def dedupe_leads(df: DataFrame, keep: str = "history_first") -> DataFrame:
    """One row per non-null lead id (rows without id dropped)."""
    cols = df.columns
    payload = F.struct(*[F.col(f"`{x}`") for x in cols])
    return (
        df.where(F.col("lead_id").isNotNull())
        .groupBy("lead_id")
        .agg(F.min(F.struct(rank_key(keep).alias("k"), payload.alias("row"))).alias("_m"))
        .select(*[F.col("_m.row").getField(x).alias(x) for x in cols])
    )


def with_response_time(df: DataFrame) -> DataFrame:
    """Fill ``response_time`` ('HH:MM:SS', hours unbounded) where it is blank and the
    reply exists and is not earlier than the inbound message. Adds the
    helper columns ``_in_ts``, ``_out_ts`` and ``_filled``."""
    d = df.withColumns({"_in_ts": combine(F.col("in_date"), F.col("in_time")),
                        "_out_ts": combine(F.col("out_date"), F.col("out_time"))})
    target = empty_cell(F.col("response_time"))
    has_out = F.col("out_date").isNotNull() & F.col("out_time").isNotNull()
    valid = F.col("_in_ts").isNotNull() & F.col("_out_ts").isNotNull() & (F.col("_out_ts") >= F.col("_in_ts"))
    filled = target & has_out & valid
    return d.withColumns({
        "_filled": filled,
        "response_time": F.when(filled, seconds_to_hms(seconds_between(F.col("_in_ts"), F.col("_out_ts"))))
        .otherwise(F.when(~target, F.col("response_time"))),
    })


def with_score(df: DataFrame, score_owner_first: bool = False) -> DataFrame:
    """Score code: time bucket where the pair is valid and the response time was
    computed now (or no score exists yet); then 'outbound' (reply before
    inbound) and 'not_answered' (no reply, complete inbound) for rows left blank."""
    d = df if "_filled" in df.columns else with_response_time(df)
    # Seconds once, in its own projection: the bucket chain reads it many times.
    d = d.withColumn("_secs", hms_to_seconds(F.col("response_time")))
    secs = F.col("_secs")
    complete = (F.col("in_date").isNotNull() & F.col("in_time").isNotNull()
                & F.col("out_date").isNotNull() & F.col("out_time").isNotNull())
    pair = F.col("_in_ts").isNotNull() & F.col("_out_ts").isNotNull()
    pt1 = F.when(
        complete & pair & (F.col("_out_ts") >= F.col("_in_ts")) & secs.isNotNull()
        & (F.col("_filled") | F.col("score").isNull()),
        score_code(secs),
    ).otherwise(F.col("score"))
    outbound = pair & (F.col("_out_ts") < F.col("_in_ts"))
    no_reply = ((F.col("out_date").isNull() | F.col("out_time").isNull())
                & F.col("in_date").isNotNull() & F.col("in_time").isNotNull())
    rest = F.when(outbound, F.lit(S.SCORE_OUTBOUND[0])).when(no_reply, F.lit(S.SCORE_NOT_ANSWERED[0]))
    if score_owner_first:
        owner_first = (F.col("in_date").isNull() & F.col("out_date").isNotNull())
        rest = rest.when(owner_first, F.lit(S.SCORE_OUTBOUND[0]))
    return d.withColumn("score", F.coalesce(pt1, rest))


def entry_segment_col():
    """Blank segments filled from the inbound hour; still blank -> 'not_registered'."""
    seg = F.when(F.col("entry_segment").isNotNull(), F.col("entry_segment")).otherwise(segment_code(F.col("in_time")))
    return F.coalesce(seg, F.lit(S.SEGMENT_NOT_REGISTERED[0]))


def with_entry_segment(df: DataFrame) -> DataFrame:
    return df.withColumn("entry_segment", entry_segment_col())


def score_leads(df: DataFrame, score_owner_first: bool = False, keep_helpers: bool = False) -> DataFrame:
    """response time -> score -> segment; adds ``response_seconds``."""
    out = with_score(with_response_time(df.withColumn("entry_segment", entry_segment_col())), score_owner_first)
    cols = [c for c in out.columns if c not in ("_filled", "_in_ts", "_out_ts", "_secs")]
    if keep_helpers:
        return out.withColumnRenamed("_secs", "response_seconds")
    return out.select(*cols, F.col("_secs").alias("response_seconds"))


def map_executive(df: DataFrame, aliases: DataFrame, col: str = "executive") -> DataFrame:
    """Rename executives through ``dim_alias`` (names not listed stay as they are)."""
    a = bounded_broadcast(aliases.select(F.col("raw_name").alias("_raw"), F.col("executive").alias("_to")))
    return (
        df.join(a, F.col(col) == F.col("_raw"), "left")
        .withColumn(col, F.coalesce(F.col("_to"), F.col(col)))
        .drop("_raw", "_to")
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


def build_leads(history: DataFrame, new_rows, keep: str = "history_first", aliases: DataFrame | None = None) -> DataFrame:
    """Consolidate, normalise times, dedupe, score: the lead table of a run. ``aliases``
    (the schedule's alias table) gives executives one name before the dedupe;
    without it only the schedule is renamed."""
    merged = normalize_lead_times(consolidate(history, new_rows))
    if aliases is not None:
        merged = map_executive(merged, aliases)
    return score_leads(dedupe_leads(merged, keep))
