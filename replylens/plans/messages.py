"""Queries over message exports (inbox and chat paths)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import dim_excluded_chat, dim_inbox, dim_owner
from ..functions import date_in_text, safe_name, strip
from ..operators.capture import (apply_capture_policy, capture_summary, chat_page_messages, dedupe_messages, eligible_chats,
                                 node_messages, page_nodes, recent_chats, skip_processed)
from ..operators.chats import chat_first_response, inbound_counts, parse_chat_export
from ..operators.inbox import inbox_first_response
from ..sources.adapters import (capture_log, chat_export_rows, chat_pages, conversation_export_rows, inbox_messages,
                                read_table)
from .registry import query


def chat_messages(spark, sf):
    return parse_chat_export(chat_export_rows(read_table(spark, sf, "events")))


@query("meta_parse")
def q_meta_parse(spark, sf):
    m = chat_messages(spark, sf)
    return m.select("executive", "contact", "dt", "msg_time", "author")


@query("chat_first_response")
def q_chat_first_response(spark, sf):
    return chat_first_response(chat_messages(spark, sf), dim_owner(spark))


@query("conversation_first_response")
def q_conversation_first_response(spark, sf):
    msgs = parse_chat_export(conversation_export_rows(read_table(spark, sf, "conversations")))
    return chat_first_response(msgs, dim_owner(spark))


@query("inbound_counts")
def q_inbound_counts(spark, sf):
    return inbound_counts(chat_first_response(chat_messages(spark, sf), dim_owner(spark)))


@query("inbox_first_response")
def q_inbox_first_response(spark, sf):
    return inbox_first_response(inbox_messages(read_table(spark, sf, "events")), dim_inbox(spark))


@query("inbox_first_response_strict")
def q_inbox_first_response_strict(spark, sf):
    return inbox_first_response(inbox_messages(read_table(spark, sf, "events")), dim_inbox(spark),
                                reply_policy="strict")


@query("inbox_date_window")
def q_inbox_date_window(spark, sf):
    return inbox_first_response(inbox_messages(read_table(spark, sf, "events")), dim_inbox(spark),
                                since="2024-01-08 06:00:00", until="2024-01-21")


@query("message_dedupe")
def q_message_dedupe(spark, sf):
    raw = chat_export_rows(read_table(spark, sf, "events"))
    # Every fifth message is collected twice, as by a collector that scrolls back.
    raw = raw.unionByName(chat_export_rows(read_table(spark, sf, "events").where(F.col("event_id") % 5 == 0)))
    # Error events stand for audio bubbles without text: their bubble text (with props) is the preview.
    media = F.col("text").startswith("error")
    raw = (raw.withColumn("kind", F.when(media, F.lit("AUDIO")))
              .withColumn("raw_text", F.col("text"))
              .withColumn("text", F.when(media, F.lit("")).otherwise(F.col("text"))))
    return dedupe_messages(raw)


@query("exclude_chats")
def q_exclude_chats(spark, sf):
    raw = chat_export_rows(read_table(spark, sf, "events"))
    return eligible_chats(raw.select("contact"), dim_excluded_chat(spark))


@query("recent_chats")
def q_recent_chats(spark, sf):
    return recent_chats(chat_messages(spark, sf), dim_excluded_chat(spark), n=25)


@query("capture_policy")
def q_capture_policy(spark, sf):
    ev = read_table(spark, sf, "events")
    return apply_capture_policy(chat_messages(spark, sf).select("contact", "dt", "author"), capture_log(ev),
                                keep_partial=False)


@query("capture_policy_keep_partial")
def q_capture_policy_keep_partial(spark, sf):
    ev = read_table(spark, sf, "events")
    return apply_capture_policy(chat_messages(spark, sf).select("contact", "dt", "author"), capture_log(ev),
                                keep_partial=True)


@query("skip_processed")
def q_skip_processed(spark, sf):
    ev = read_table(spark, sf, "events")
    cands = chat_export_rows(ev).select("contact").distinct()
    return skip_processed(cands, capture_log(ev))


@query("capture_summary")
def q_capture_summary(spark, sf):
    return capture_summary(capture_log(read_table(spark, sf, "events")))


@query("page_messages")
def q_page_messages(spark, sf):
    return node_messages(page_nodes(read_table(spark, sf, "pages"), "href"))


@query("chat_page_messages")
def q_chat_page_messages(spark, sf):
    """Stored chat pages -> message nodes and media bubbles -> collected messages."""
    found = chat_page_messages(chat_pages(read_table(spark, sf, "conversations")))
    return dedupe_messages(found.withColumn("contact", F.concat(F.lit("conv "), F.col("page_id").cast("string"))))


@query("safe_name")
def q_safe_name(spark, sf):
    raw = chat_export_rows(read_table(spark, sf, "events"))
    names = raw.select(F.concat(F.col("contact"), F.lit(" / "), F.col("executive"), F.lit(" #1")).alias("name")).distinct()
    return names.select("name", safe_name(F.col("name")).alias("safe"))


@query("date_in_text")
def q_date_in_text(spark, sf):
    raw = chat_export_rows(read_table(spark, sf, "events"))
    return raw.select(strip(F.col("meta")).alias("meta"), date_in_text(F.col("meta")).alias("found"))
