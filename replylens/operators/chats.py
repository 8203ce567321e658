"""Raw chat exports -> parsed messages -> one lead row per chat.

A chat is ``(executive, contact)``: many export files are read at once, one per
executive. See ``chat_first_response`` for the plan (two aggregates and a
window over per-minute rows; raw messages parsed once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import norm_name, strip, time_text, with_parsed_meta
from .joins import bounded_broadcast, small_values
from .partitioning import spread

CHAT = ["executive", "contact"]


def parse_chat_export(raw: DataFrame, strict_ampm: bool = False, keep_unparsed: bool = False) -> DataFrame:
    """(executive, contact, meta, text) -> + dt, msg_time, author; rows whose meta
    does not give a valid timestamp are dropped unless ``keep_unparsed``."""
    df = spread(raw).select(*[
        strip(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in ("contact", "meta", "text") else F.col(c)
        for c in raw.columns])
    return with_parsed_meta(df, "meta", strict_ampm=strict_ampm, keep_unparsed=keep_unparsed)


def mark_owner(msgs: DataFrame, owners: DataFrame) -> DataFrame:
    """Add ``role``: 'owner' when the normalised author is a listed owner name or
    the chat's executive, 'contact' for any other author, null without author.
    A small owner list becomes an ``isin`` test (size-checked); a large one a join."""
    names = owners.select(norm_name(F.col("name")).alias("_owner"))
    listed = small_values(names, "_owner")
    a = norm_name(F.col("author"))
    if listed is not None:
        df = msgs.withColumn("_na", a).withColumn("_own", F.col("_na").isin(listed))
    else:
        df = msgs.withColumn("_na", a).join(bounded_broadcast(names.distinct()), F.col("_na") == F.col("_owner"), "left")
        df = df.withColumn("_own", F.col("_owner").isNotNull()).drop("_owner")
    is_owner = F.col("_own") | (F.col("_na") == norm_name(F.col("executive")))
    role = F.when(F.col("author").isNull(), F.lit(None).cast("string")).when(is_owner, "owner").otherwise("contact")
    return df.withColumn("role", role).drop("_na", "_own")


def chat_first_response(msgs: DataFrame, owners: DataFrame) -> DataFrame:
    """Per chat exactly one of three shapes:

    * (inbound, reply): a contact wrote in the first minute; the reply is the
      first owner message in a later minute;
    * (inbound, no reply);
    * (no inbound, outbound): nobody but the owner (or no author) wrote in the
      first minute; the outbound fields are the first minute.

    Messages carry minute precision, so the plan first reduces them to one row
    per (chat, minute) with contact/owner flags - a partially aggregated
    shuffle that merges a huge chat map-side - and then finds the first minute
    with a window over each chat's distinct minutes (bounded by the length of
    the chat in minutes, not by its message count). Raw messages are read
    and parsed once.
    """
    m = mark_owner(msgs, owners)
    minutes = m.groupBy(*CHAT, "dt").agg(
        F.max(F.coalesce((F.col("role") == "contact").cast("int"), F.lit(0))).alias("_c"),
        F.max(F.coalesce((F.col("role") == "owner").cast("int"), F.lit(0))).alias("_o"),
    )
    minutes = minutes.withColumn("first_dt", F.min("dt").over(Window.partitionBy(*CHAT)))
    out = minutes.groupBy(*CHAT).agg(
        F.min("first_dt").alias("first_dt"),
        F.max(F.when(F.col("dt") == F.col("first_dt"), F.col("_c"))).alias("_in"),
        F.min(F.when((F.col("_o") == 1) & (F.col("dt") > F.col("first_dt")), F.col("dt"))).alias("_reply"),
    ).withColumn("_in", F.col("_in") == 1)
    in_ts = F.when(F.col("_in"), F.col("first_dt"))
    out_ts = F.when(F.col("_in"), F.col("_reply")).otherwise(F.col("first_dt"))
    return out.select(
        "executive",
        F.col("contact").alias("lead_id"),
        F.col("_in").alias("has_inbound"),
        out_ts.isNotNull().alias("has_outbound"),
        F.to_date(in_ts).alias("in_date"),
        time_text(in_ts).alias("in_time"),
        F.to_date(out_ts).alias("out_date"),
        time_text(out_ts).alias("out_time"),
    )


def inbound_counts(leads: DataFrame) -> DataFrame:
    """Chats per inbound flag plus a total row (flag null, ``is_total`` true)."""
    return (
        leads.rollup("has_inbound")
        .agg(F.count(F.lit(1)).alias("chats"), F.grouping("has_inbound").cast("boolean").alias("is_total"))
    )
