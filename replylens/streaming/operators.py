"""Structured Streaming forms of the incremental operators.

All state is built-in (watermarked dedupe, session-window aggregates); no
Python state functions, so streams run fully in the JVM. Event time must be a
TIMESTAMP column (watermarks refuse TIMESTAMP_NTZ).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chats import mark_owner, parse_chat_export
from ..sources.csv_scan import decoded, executive_of

CHAT = ["executive", "contact"]


def dedupe_stream(msgs: DataFrame, event_time: str = "ts", delay: str = "1 hour",
                  keys=("contact", "meta", "text")) -> DataFrame:
    """Collected messages without repeats; a key's state lives until the
    watermark passes its first event time plus ``delay`` (bounded state)."""
    return msgs.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _session_end(last: str, gap: str):
    """From the last event, not the window column: a filter on that would be pushed below the merging of sessions."""
    return (F.col(last) + F.expr(f"INTERVAL '{gap}'")).alias("session_end")


def session_counts(msgs: DataFrame, event_time: str = "ts", gap: str = "30 minutes",
                   delay: str = "1 hour", key: str = "contact") -> DataFrame:
    """Contact sessions (activity separated by ``gap``), emitted once closed."""
    return (
        msgs.withWatermark(event_time, delay)
        .groupBy(key, F.session_window(event_time, gap).alias("session"))
        .agg(F.count(F.lit(1)).alias("messages"), F.min(event_time).alias("first_ts"),
             F.max(event_time).alias("last_ts"))
        .select(key, F.col("session.start").alias("session_start"), _session_end("last_ts", gap),
                "messages", "first_ts", "last_ts")
    )


def first_response_stream(msgs: DataFrame, event_time: str = "ts", gap: str = "2 hours",
                          delay: str = "1 hour") -> DataFrame:
    """Chat first-response rule per contact session, emitted once the session closes.

    ``msgs`` has executive, contact, role ('owner' / 'contact' / null) and the
    minute-precision event time. Per session: the first minute, whether a
    contact wrote in it, and the owner minutes (a set of distinct minutes,
    bounded by the session's length in minutes, not by its message count);
    the reply is the first owner minute after the first minute.
    """
    t = F.col(event_time)
    agg = (
        msgs.withWatermark(event_time, delay)
        .groupBy(*CHAT, F.session_window(event_time, gap).alias("session"))
        .agg(
            F.min(t).alias("first_ts"),
            F.max(t).alias("last_ts"),
            F.min(F.when(F.col("role") == "contact", t)).alias("contact_ts"),
            F.array_sort(F.collect_set(F.when(F.col("role") == "owner", t))).alias("owner_ts"),
        )
    )
    inbound = F.coalesce(F.col("contact_ts") == F.col("first_ts"), F.lit(False))
    after = F.try_element_at(F.filter("owner_ts", lambda x: x > F.col("first_ts")), F.lit(1))
    reply = F.when(inbound, after).otherwise(F.col("first_ts"))
    return agg.select(
        *CHAT,
        F.col("session.start").alias("session_start"),
        _session_end("last_ts", gap),
        inbound.alias("has_inbound"),
        reply.isNotNull().alias("has_outbound"),
        F.when(inbound, F.col("first_ts")).alias("in_ts"),
        reply.alias("out_ts"),
    )


def open_sessions(msgs: DataFrame, make, keys, event_time: str = "ts", gap: str = "30 minutes",
                  delay: str = "1 hour") -> DataFrame:
    """The closing step of a session stream whose input has ended: the sessions it still holds, as ``make`` gives them
    (``make``: the same builder with the same gap and delay; it needs a column ``session_end``). A stream has output
    the sessions that end at or before its last watermark, the greatest event time less ``delay``; the
    others belong to keys active since. Only these keys' rows are read again, in a batch, so
    stream output and this together are the sessions of all rows (rows that came too late apart)."""
    last = msgs.agg(F.max(event_time).alias("t")).first()["t"]
    if last is None:
        return make(msgs).limit(0)
    mark = F.lit(last) - F.expr(f"INTERVAL '{delay}'")
    recent = msgs.where(F.col(event_time) + F.expr(f"INTERVAL '{gap}'") > mark).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    held = msgs.join(recent, reduce(lambda a, b: a & b, same), "left_semi")
    return make(held).where(F.col("session_end") > mark)


def read_export_stream(spark, folder: str, max_files_per_trigger: int = 1_000) -> DataFrame:
    """Raw chat exports (contact, meta, text) as they arrive, with their executive; cells may hold line breaks.
    A row with too few or too many cells keeps its line in ``_corrupt``; a file with other headers is an error."""
    raw = (spark.readStream.schema("contact string, meta string, text string, _corrupt string")
           .option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True)
           .option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.[cC][sS][vV]").option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))
    return raw.select(executive_of(decoded(F.col("_metadata.file_path"))).alias("executive"), "contact", "meta", "text", "_corrupt")


def parse_export_stream(raw: DataFrame, owners: DataFrame, event_time: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(messages with time, author and role; rejected rows with a reason). No row is in neither: a row is rejected when
    its cells or its meta do not parse."""
    broken = F.col("_corrupt").isNotNull()
    parsed = parse_chat_export(raw.where(~broken).drop("_corrupt"), keep_unparsed=True)
    good = mark_owner(parsed.where(F.col("dt").isNotNull()), owners).withColumn(event_time, F.col("dt").cast("timestamp"))
    cells = ["executive", "contact", "meta", "text"]
    rejected = (raw.where(broken).select(*cells, F.lit("cells").alias("reason"))
                .unionByName(parsed.where(F.col("dt").isNull()).select(*cells, F.lit("meta").alias("reason"))))
    return good, rejected


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> str:
    """Process everything available now (in as many micro-batches as the source
    options give) into a file sink with exactly-once commit, then stop."""
    q = (stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sink_path
