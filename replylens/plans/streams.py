"""Streaming queries: staged input -> availableNow stream -> sink, read back.

The input is staged in two distributed writes cut at the middle of its time
range, oldest first, and the stream runs once after each: the second run starts
from the first one's checkpoint and its rows are never older than the watermark.
Every row goes to exactly one of the two (rows without a time to the second).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import dim_owner
from ..operators.chats import mark_owner, parse_chat_export
from ..operators.leads import coerce_history
from ..session import scratch_path, stored
from ..sources.adapters import AS_OF, chat_export_rows, read_table
from ..streaming import (consolidate_stream, dedupe_stream, first_response_stream, open_sessions, parse_export_stream, read_export_stream,
                         run_available, session_counts)
from .leads import files, new_file_frames
from .registry import query


def middle(df, ts="ts"):
    """The middle of the time range (one aggregated row), or None for no rows."""
    r = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
    return r["a"] + (r["b"] - r["a"]) / 2 if r["a"] is not None else None


def halves(df, ts="ts"):
    """(earlier rows, all other rows): no row is in neither or in both."""
    cut = middle(df, ts)
    early = F.coalesce(F.col(ts) < F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)
    return df.where(early), df.where(~early)


def run_staged(spark, df, make, name, ts="ts"):
    """Feed ``df`` through ``make(stream)`` in two runs over one checkpoint; the sink's rows."""
    inbox, sink, ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("in", "out", "ckpt"))
    for i, part in enumerate(halves(df, ts)):
        part.write.parquet(f"{inbox}/part-{i}")
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(inbox)
        run_available(make(stream), sink, ckpt)
    return spark.read.parquet(sink)


def _messages(spark, sf, collected_again=False):
    """Parsed chat messages with whole texts; ``collected_again`` adds a second copy of every fifth
    event, as a collector that scrolls back would. Parsed once and stored: the cut, both stagings and the
    closing step read them."""
    events = read_table(spark, sf, "events")
    if collected_again:
        events = events.unionByName(events.where(F.col("event_id") % 5 == 0))
    msgs = parse_chat_export(chat_export_rows(events))
    msgs = mark_owner(msgs, dim_owner(spark)).withColumn("ts", F.col("dt").cast("timestamp"))
    return stored(msgs.select("executive", "contact", "meta", "text", "role", "ts"), "messages")


@query("stream_message_dedupe")
def q_stream_message_dedupe(spark, sf):
    out = run_staged(spark, _messages(spark, sf, collected_again=True), lambda m: dedupe_stream(m, "ts", "1 hour"), "dedupe")
    return out.select("contact", "meta", "text")


def all_sessions(spark, msgs, make, keys, gap, delay, name):
    """The stream's closed sessions and, its input having ended, those it still holds."""
    closed = run_staged(spark, msgs, make, name)
    return closed.unionByName(open_sessions(msgs, make, keys, "ts", gap, delay))


@query("stream_sessions")
def q_stream_sessions(spark, sf):
    out = all_sessions(spark, _messages(spark, sf), lambda m: session_counts(m, "ts", "30 minutes", "1 hour"), ["contact"],
                       "30 minutes", "1 hour", "sessions")
    return out.select("contact", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "messages")


@query("stream_first_response")
def q_stream_first_response(spark, sf):
    out = all_sessions(spark, _messages(spark, sf), lambda m: first_response_stream(m, "ts", "2 hours", "1 hour"),
                       ["executive", "contact"], "2 hours", "1 hour", "first")
    return out.select("executive", "contact", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      "has_inbound", "has_outbound", F.col("in_ts").cast("timestamp_ntz").alias("in_ts"),
                      F.col("out_ts").cast("timestamp_ntz").alias("out_ts"))


@query("stream_raw_exports")
def q_stream_raw_exports(spark, sf):
    """Raw export files stream in two runs: parsed messages with their roles, and the rows that do not parse."""
    events = read_table(spark, sf, "events")
    odd = F.col("event_id") % 50 == 0
    raw = chat_export_rows(events.where(~odd)).unionByName(
        chat_export_rows(events.where(odd)).withColumn("meta", F.concat(F.lit("? "), "meta")))
    raw = raw.withColumn("text", F.concat("text", F.lit('\nsecond "line", end')))
    inbox, sink, ckpt, bad, bad_ckpt = (scratch_path(spark, f"raw-{x}") for x in ("in", "out", "ckpt", "bad", "bad-ckpt"))
    for i in range(2):
        part = raw.where(F.pmod(F.xxhash64("contact", "meta"), F.lit(2)) == i)
        part.write.partitionBy("executive").option("header", True).option("escape", '"').csv(f"{inbox}/run-{i}")
        good, rejected = parse_export_stream(read_export_stream(spark, inbox), dim_owner(spark))
        run_available(good.drop("ts"), sink, ckpt)
        run_available(rejected, bad, bad_ckpt)
    cols = ["executive", "contact", "meta", "text"]
    return spark.read.parquet(sink).select(*cols, "dt", "role", F.lit(None).cast("string").alias("reason")).unionByName(
        spark.read.parquet(bad).select(*cols, F.lit(None).cast("timestamp_ntz").alias("dt"), F.lit(None).cast("string").alias("role"), "reason"))


@query("stream_consolidate")
def q_stream_consolidate(spark, sf):
    """New lead files of three layouts arrive and are merged into a new snapshot."""
    history, new = files(spark, sf)
    inbox = scratch_path(spark, "lead-inbox")
    for i, f in enumerate(new_file_frames(new)):
        f.write.option("header", True).option("escape", '"').csv(f"{inbox}/batch_{i}")
    return consolidate_stream(spark, inbox, scratch_path(spark, "snapshots"), coerce_history(history), AS_OF,
                              scratch_path(spark, "consolidate-ckpt"), max_files_per_trigger=1_000, buckets=16)
