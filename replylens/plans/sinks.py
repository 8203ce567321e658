"""Queries that write files with the sinks and read them back with the scanners.

Fixture files are written by Spark from the test tables into the shared
checkpoint folder (a fresh sub-folder per call), then scanned.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import dim_inbox, dim_owner
from ..functions import yes_flag
from ..operators.capture import dedupe_messages
from ..operators.chats import chat_first_response, parse_chat_export
from ..operators.inbox import inbox_first_response
from ..operators.leads import coerce_history
from ..operators.profile import executive_date_slice
from ..session import scratch_path, stored
from ..sinks import write_by_executive, write_lead_csv, write_messages, write_snapshot
from ..sources.adapters import AS_OF, chat_export_rows, inbox_messages, read_table
from ..sources.csv_scan import read_chat_export, read_history, read_inbox_export, read_new_leads
from .leads import files, new_file_frames, scored_leads
from .registry import query


def _csv(df, path):
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


@query("scan_mixed_headers")
def q_scan_mixed_headers(spark, sf):
    """Three lead-file layouts (different header orders, one without ID_LEAD, one
    without reply columns, one in a sub-folder) plus files with no wanted column."""
    root = scratch_path(spark, "lead-files")
    _, new = files(spark, sf)
    wide = [F.lit("x").alias(f"an own column of the user, number {i}") for i in range(2_500)]
    for i, f in enumerate(new_file_frames(new)):
        # The first layout begins with a header of more than 64 KB of other columns.
        _csv(f.select(*wide, *f.columns) if i == 0 else f, f"{root}/week/sub/batch_{i}" if i == 2 else f"{root}/batch_{i}")
    _csv(read_table(spark, sf, "events").select("event_id", "event_type"), f"{root}/unrelated")
    return read_new_leads(spark, [root, f"{root}/missing-folder"], AS_OF)


NAME_PREFIX = "Ana María 5% #1+ "
# Cells that only a correct pair of CSV writer and reader keeps apart.
HOSTILE = ' said "hi", ok;\n"x", \\ end'


@query("chat_export_scan")
def q_chat_export_scan(spark, sf):
    """Raw chat exports, one folder per executive, read back strictly and parsed."""
    root = scratch_path(spark, "chat-export")
    raw = chat_export_rows(read_table(spark, sf, "events"))
    # Files and folders are named after people: blanks, accents, per cent and number signs.
    raw = raw.withColumn("executive", F.concat(F.lit(NAME_PREFIX), F.col("executive")))
    raw.write.partitionBy("executive").option("header", True).option("escape", '"').csv(root)
    msgs = parse_chat_export(read_chat_export(spark, root))
    return msgs.select("executive", "contact", "dt", "msg_time", "author")


FIXTURE_BUCKETS = 64


def inbox_fixture(spark, sf):
    """Inbox export files, one per (inbox, message-id bucket): a file holds a
    64th of an inbox, never a whole one. Some of inbox 2's rows carry
    unparsable timestamps (their files must be skipped whole), and a further
    file lacks the ``sent_at`` column."""
    root = scratch_path(spark, "inbox-export")
    m = inbox_messages(read_table(spark, sf, "events"))
    txt = F.date_format("sent_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    # Every third conversation has a text id.
    m = m.withColumn("conversation_id", F.concat(F.when(F.col("conversation_id") % 3 == 0, "A-").otherwise(""), F.col("conversation_id").cast("string")))
    m = m.withColumn("sent_at", F.when((F.col("inbox_id") == 2) & (F.col("message_id") % 97 == 0),
                                       F.lit("not a date")).otherwise(txt))
    m = m.withColumn("box", F.col("inbox_id")).withColumn("bucket", F.col("message_id") % FIXTURE_BUCKETS)
    m.repartition("box", "bucket").write.partitionBy("box", "bucket") \
        .option("header", True).option("escape", '"').csv(root)
    _csv(m.where(F.col("inbox_id") == 1).drop("sent_at", "box", "bucket"), f"{root}/no_sent_at")
    return root


@query("inbox_scan_skip_bad_files")
def q_inbox_scan_skip_bad_files(spark, sf):
    root = inbox_fixture(spark, sf)
    return inbox_first_response(read_inbox_export(spark, root, recursive=True), dim_inbox(spark))


@query("export_by_executive")
def q_export_by_executive(spark, sf):
    """Per-executive export folders, written twice and read back row by row."""
    root = scratch_path(spark, "exports")
    leads = inbox_first_response(inbox_messages(read_table(spark, sf, "events")), dim_inbox(spark))
    # The second run of the date replaces the first, an executive that it no longer has included.
    write_by_executive(leads.withColumn("executive", F.concat("executive", F.lit(" (old)"))), root, AS_OF)
    write_by_executive(leads, root, AS_OF)
    back = spark.read.option("header", True).option("inferSchema", False).csv(root)
    return back.select(
        F.col("executive"), F.col("ID_LEAD").alias("lead_id"), yes_flag("Mensaje Entrante").alias("has_inbound"),
        yes_flag("Mensaje Saliente").alias("has_outbound"), F.col("Fecha Entrante").cast("date").alias("in_date"),
        F.col("Hora Entrante").alias("in_time"), F.col("Fecha Saliente").cast("date").alias("out_date"),
        F.col("Hora Saliente").alias("out_time"))


@query("messages_csv_roundtrip")
def q_messages_csv_roundtrip(spark, sf):
    """Collected messages with quotes, commas, line breaks and backslashes, written and read back cell by cell."""
    root = scratch_path(spark, "messages")
    raw = chat_export_rows(read_table(spark, sf, "events")).withColumn("text", F.concat("text", F.lit(HOSTILE)))
    write_messages(dedupe_messages(raw), root)
    return read_chat_export(spark, root).select("contact", "meta", "text")


@query("chat_rows_csv")
def q_chat_rows_csv(spark, sf):
    """One row per chat, written as a lead file by executive, lead and time, and read back as history."""
    path = scratch_path(spark, "chat-rows")
    write_lead_csv(chat_first_response(parse_chat_export(chat_export_rows(read_table(spark, sf, "events"))), dim_owner(spark)), path)
    return read_history(spark, path).select("executive", "lead_id", "has_inbound", "has_outbound", "in_date", "in_time", "out_date", "out_time")


@query("slice_csv_roundtrip")
def q_slice_csv_roundtrip(spark, sf):
    """One executive's leads of four years, written as a lead file and read back."""
    path = scratch_path(spark, "slice")
    write_lead_csv(executive_date_slice(scored_leads(spark, sf), "agent_b", "1996-01-01", "1999-12-31"), path)
    return read_history(spark, path)


@query("history_own_columns")
def q_history_own_columns(spark, sf):
    """A history with a notes column and a label of its own: both survive a run's write and re-read."""
    history, _ = files(spark, sf)
    odd = F.col("ID_LEAD").cast("long") % 7 == 0
    history = (history.withColumn("Score Tiempo Respuesta", F.when(odd, F.lit("VIP manual")).otherwise(F.col("Score Tiempo Respuesta")))
               .withColumn("Notas", F.concat(F.lit('nota "'), F.col("ID_LEAD"), F.lit('",\nfin'))))
    path = scratch_path(spark, "own-history")
    write_lead_csv(coerce_history(history), path, sort=False, header=history.columns)
    return read_history(spark, path).select("executive", "lead_id", "in_date", "in_time", "score", "entry_segment", "Notas")


@query("lead_csv_roundtrip")
def q_lead_csv_roundtrip(spark, sf):
    """Scored leads written as history snapshots by two runs of one day (the first without its answered leads);
    the next run's history is the published one. Two sorted writes read the leads (each samples its order first), so they
    are scored once and stored."""
    root = scratch_path(spark, "history")
    leads = stored(scored_leads(spark, sf), "scored")
    write_snapshot(leads.where("not has_outbound"), root, AS_OF)
    write_snapshot(leads, root, AS_OF)
    return read_history(spark, root)
