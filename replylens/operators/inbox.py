"""Support-inbox export -> one lead row per conversation (first message, first reply).

Plan: one scan. The rows of a conversation are of four kinds (agent or not, system or not) and
only the two earliest of each kind matter, so a rank within (conversation, kind) keeps
those - Spark limits the groups before the shuffle (WindowGroupLimit), so a
conversation holding a third of all rows sends eight rows a task - and one small aggregate
over what is left gives first row, first real row and reply.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import strip, time_text
from .joins import bounded_broadcast


def is_system_message(content, markers=S.SYSTEM_MARKERS):
    """Automatic-assignment message: the content holds every marker (null content never does)."""
    c = F.coalesce(F.col(content) if isinstance(content, str) else content, F.lit(""))
    cond = F.lit(True)
    for m in markers:
        cond = cond & c.contains(m)
    return cond


def prepare_inbox(messages: DataFrame, dim_inbox: DataFrame, offset_hours: int = 5) -> DataFrame:
    """Drop rows without timestamp, shift clock by ``-offset_hours``, keep known
    inboxes and attach their executive (broadcast lookup, size-checked)."""
    m = messages.where(F.col("sent_at").isNotNull())
    if offset_hours:
        m = m.withColumn("sent_at", F.col("sent_at") - F.make_dt_interval(hours=F.lit(offset_hours)))
    if "message_id" not in m.columns:
        m = m.withColumn("message_id", F.lit(None).cast("bigint"))
    return m.join(bounded_broadcast(dim_inbox.select("inbox_id", "executive")), "inbox_id", "inner")


def _key(has_id: bool):
    # Order inside a conversation: time, then message id and sender; whole contents only break
    # ties of exports without ids, so they usually stay out of the sort key and the shuffle.
    return F.struct("sent_at", "message_id", "sender_type", *([] if has_id else ["content"]))


def inbox_first_response(messages: DataFrame, dim_inbox: DataFrame, *, since=None, until=None,
                         offset_hours: int = 5, reply_policy: str = "reference",
                         markers=S.SYSTEM_MARKERS, group_suffix: str = S.GROUP_SUFFIX) -> DataFrame:
    """One row per conversation.

    * first real message = earliest row that is not an automatic assignment;
      a conversation without one is dropped; group conversations are dropped;
      ``since``/``until`` bound that first message (inclusive, timestamps).
    * ``reply_policy="reference"``: reply = earliest agent row that is not the
      first row of the whole conversation (system rows count for position).
      ``"strict"``: earliest non-system agent row after the first real message.
    """
    m = prepare_inbox(messages, dim_inbox, offset_hours)
    m = m.withColumn("_sys", is_system_message("content", markers)).withColumn("_k", _key("message_id" in messages.columns))
    m = m.where(F.col("conversation_id").isNotNull()).withColumn("_agent", F.coalesce(F.col("sender_type") == S.SENDER_AGENT, F.lit(False)))
    # The second of two agent rows is the reply when the first one opens the conversation; rows equal in every key are one.
    kinds = W.partitionBy("conversation_id", "_agent", "_sys").orderBy("_k")
    top = m.withColumn("_r", F.dense_rank().over(kinds)).where(F.col("_r") <= 2)
    if reply_policy == "reference":
        replies, anchor = F.col("_agent"), F.col("first_all")
    elif reply_policy == "strict":
        replies, anchor = F.col("_agent") & ~F.col("_sys"), F.col("first_real.k")
    else:
        raise ValueError(f"unknown reply_policy {reply_policy!r}")
    firsts = top.groupBy("conversation_id").agg(
        F.min("_k").alias("first_all"),
        F.min(F.when(~F.col("_sys"), F.struct(
            F.col("_k").alias("k"), "executive", "sender_type", "contact_name"))).alias("first_real"),
        F.collect_set(F.when(replies, F.col("_k"))).alias("_replies"),
    )
    out = firsts.where(F.col("first_real").isNotNull()).withColumn(
        "_reply", F.array_min(F.filter("_replies", lambda k: k > anchor)))
    first_ts = F.col("first_real.k.sent_at")
    out = out.where(~strip(F.coalesce(F.col("first_real.contact_name"), F.lit("nan"))).endswith(group_suffix))
    if since is not None:
        out = out.where(first_ts >= _ntz(since))
    if until is not None:
        out = out.where(first_ts <= _ntz(until))
    reply_ts = F.col("_reply.sent_at")
    return out.select(
        F.col("first_real.executive").alias("executive"),
        F.col("conversation_id").cast("string").alias("lead_id"),
        (F.col("first_real.sender_type") == S.SENDER_CONTACT).alias("has_inbound"),
        reply_ts.isNotNull().alias("has_outbound"),
        F.to_date(first_ts).alias("in_date"),
        time_text(first_ts).alias("in_time"),
        F.to_date(reply_ts).alias("out_date"),
        time_text(reply_ts).alias("out_time"),
    )


def _ntz(x):
    """Bound as a TIMESTAMP_NTZ literal (wall clock, independent of the session
    time zone); a date-only bound means that day's midnight."""
    if isinstance(x, _dt.datetime):
        ts = x
    elif isinstance(x, _dt.date):
        ts = _dt.datetime(x.year, x.month, x.day)
    else:
        ts = _dt.datetime.fromisoformat(str(x))
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
