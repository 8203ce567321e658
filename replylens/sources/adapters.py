"""Adapters: the provided test tables -> the shapes the operators consume.

Each adapter is a plain Spark projection/explode of a given table, so the work
grows with the data. The same rules are spelled out in SQL in
``plans/oracle.py`` for the DuckDB cross-check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import TEST_EXECUTIVES
from ..operators.partitioning import spread

AS_OF = _dt.date(2026, 1, 22)
SHEET_NAME = "week_grid"
# Shift texts written into the derived sheets (invented; one unknown word).
SHEET_SHIFT_TEXTS = ["Mañana", "manana", "TARDE", "turno tarde", "libre", "Tarde/Mañana"]
# Operator names as typed in the derived sheet (two go through dim_alias).
SHEET_OPERATORS = ["AGENT_A", "agent_b", " ag.c ", "agent_d", "agent_e"]


# Fact tables whose rows feed CPU-heavy text work (parsed per row).
FACT_TABLES = ("events", "orders", "conversations", "pages")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; fact tables are spread over the cluster's cores when the file
    has fewer splits than cores (a no-op on large inputs)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return spread(df, key=path) if name in FACT_TABLES else df


def _agent(n) -> F.Column:
    return F.concat(F.lit("agent_"), F.char(F.lit(97) + n % 5))


# ---------------------------------------------------------------- B1 inbox
def inbox_messages(events: DataFrame) -> DataFrame:
    """events -> inbox export rows (conversation = user and day)."""
    uid = F.col("user_id")
    return events.select(
        F.col("event_id").alias("message_id"),
        (uid * 100 + F.dayofmonth("ts")).cast("bigint").alias("conversation_id"),
        (uid % 7).cast("bigint").alias("inbox_id"),
        F.when(F.col("event_type").isin("purchase", "error"), F.lit("User")).otherwise(F.lit("Contact")).alias("sender_type"),
        F.col("ts").alias("sent_at"),
        F.concat(F.lit("contact "), uid.cast("string"),
                 F.when(uid % 10 == 0, F.lit(" (GROUP)")).otherwise(F.lit(""))).alias("contact_name"),
        F.when(F.col("event_type") == "error", F.lit("Asignado a agent por Automation System"))
        .otherwise(F.col("event_type")).alias("content"),
    )


# ---------------------------------------------------------------- B2 chats
def chat_export_rows(events: DataFrame) -> DataFrame:
    """events -> raw chat export rows (executive, contact, meta, text) in three meta styles."""
    ts = F.col("ts")
    contact = F.concat(F.lit("contact "), F.col("user_id").cast("string"))
    author = (F.when(F.col("event_type") == "purchase", F.lit("You"))
              .when(F.col("event_type") == "error", F.lit(None).cast("string"))
              .otherwise(contact))
    style = F.col("event_id") % 3
    clock = (
        F.when(style == 0, F.date_format(ts, "H:mm"))
        .when(style == 1, F.concat(F.date_format(ts, "h:mm"), F.lit("\u202f"),
                                   F.when(F.hour(ts) < 12, F.lit("a.\u00a0m.")).otherwise(F.lit("p.\u00a0m."))))
        .otherwise(F.date_format(ts, "h:mm a"))
    )
    meta = F.concat(F.lit("["), clock, F.lit(", "), F.date_format(ts, "d/M/yyyy"), F.lit("] "),
                    F.coalesce(F.concat(author, F.lit(": ")), F.lit("")))
    return events.select(
        _agent(F.col("user_id")).alias("executive"),
        contact.alias("contact"),
        meta.alias("meta"),
        F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("text"),
    )


# ---------------------------------------------------------------- B5 conversations
def conversation_export_rows(conversations: DataFrame) -> DataFrame:
    """conversations -> raw chat export rows; assistant = owner, user = contact, system = no author."""
    base = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")   # NTZ literal: session time zone plays no part
    dt = (base + F.make_dt_interval(hours=F.col("conv_id").cast("int"))
          + F.make_dt_interval(mins=(F.col("turn") * 7).cast("int")))
    contact = F.concat(F.lit("conv "), F.col("conv_id").cast("string"))
    author = (F.when(F.col("role") == "assistant", F.lit("Me"))
              .when(F.col("role") == "user", contact)
              .otherwise(F.lit(None).cast("string")))
    meta = F.concat(F.lit("["), F.date_format(dt, "H:mm"), F.lit(", "), F.date_format(dt, "d/M/yyyy"),
                    F.lit("] "), F.coalesce(F.concat(author, F.lit(": ")), F.lit("")))
    return conversations.select(
        _agent(F.col("conv_id")).alias("executive"), contact.alias("contact"), meta.alias("meta"),
        F.col("text").alias("text"))


# ---------------------------------------------------------------- B3 leads
def lead_facts(orders: DataFrame) -> DataFrame:
    """Typed lead facts of every order: lead, executive, inbound and reply timestamps."""
    k = F.col("o_orderkey")
    in_ts = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=(k * 7919 % 86400).cast("int"))
    r = k % 8
    delta = (F.when(r == 0, 20).when(r == 1, 200).when(r == 2, 800).when(r == 3, 3000)
             .when(r == 4, 40000).when(r == 5, 500000).when(r == 6, -600).otherwise(k * 37 % 200000))
    out_ts = F.when(k % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        in_ts + F.make_dt_interval(secs=delta.cast("int")))
    return orders.select(
        k.alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("lead_id"),
        _agent(k).alias("executive"),
        in_ts.cast("timestamp_ntz").alias("in_ts"),
        out_ts.cast("timestamp_ntz").alias("out_ts"),
        (k % 2).cast("int").alias("source_rank"),
    )


def _iso(ts):
    return F.date_format(ts, "yyyy-MM-dd")


def _flag(b):
    return F.when(b, F.lit("SI")).otherwise(F.lit("NO"))


def lead_files(orders: DataFrame, styled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(history, new) lead rows as text with Spanish headers.

    History = even order keys, written by an earlier run: ISO dates,
    'HH:mm:ss' times, some response/score/segment cells already filled.
    New = odd order keys; with ``styled`` their inbound date/time cells use
    the free-form styles the normalisers must handle.
    """
    f = lead_facts(orders)
    s = F.floor(F.col("o_orderkey") / 2)
    in_ts, out_ts = F.col("in_ts"), F.col("out_ts")
    common = [
        F.col("executive").alias("Ejecutivo"),
        F.col("lead_id").alias("ID_LEAD"),
        F.lit("SI").alias("Mensaje Entrante"),
        _flag(out_ts.isNotNull()).alias("Mensaje Saliente"),
    ]
    out_cells = [_iso(out_ts).alias("Fecha Saliente"), F.date_format(out_ts, "HH:mm:ss").alias("Hora Saliente")]
    hist = f.where(F.col("source_rank") == 0)
    pre = s % 5
    history = hist.select(
        *common,
        _iso(in_ts).alias("Fecha Entrante"),
        F.date_format(in_ts, "HH:mm:ss").alias("Hora Entrante"),
        *out_cells,
        F.when(pre == 0, F.lit("30:00:00")).when(pre == 1, F.lit("00:00:30")).alias("Tiempo Respuesta (min)"),
        F.when(pre == 1, F.lit("🟢 Excelente")).when(pre == 3, F.lit("🔴 Lento")).alias("Score Tiempo Respuesta"),
        F.when(pre == 2, F.lit("🌆 Noche")).alias("Segmento Horario Entrada"),
        F.lit("history").alias("source_file"),
    )
    new = f.where(F.col("source_rank") == 1)
    if styled:
        ds, ts_ = s % 6, F.floor(F.col("o_orderkey") / 12) % 4
        in_date = (F.when(ds == 0, _iso(in_ts)).when(ds == 1, F.date_format(in_ts, "d/M/yyyy"))
                   .when(ds == 2, F.date_format(in_ts, "yyyy-MM-dd HH:mm:ss")).when(ds == 3, F.lit("hoy"))
                   .when(ds == 4, F.lit(" Ayer ")).otherwise(F.lit("nan")))
        in_time = (F.when(ts_ == 0, F.date_format(in_ts, "HH:mm:ss")).when(ts_ == 1, F.date_format(in_ts, "HH:mm"))
                   .when(ts_ == 2, F.date_format(in_ts, "HH:mm:ss.SSSSSS")).otherwise(F.lit("")))
    else:
        in_date, in_time = _iso(in_ts), F.date_format(in_ts, "HH:mm:ss")
    new = new.select(*common, in_date.alias("Fecha Entrante"), in_time.alias("Hora Entrante"), *out_cells,
                     F.concat(F.lit("new_"), (F.col("o_orderkey") % 3).cast("string"), F.lit(".csv")).alias("source_file"))
    return history, new


def lead_table(orders: DataFrame) -> DataFrame:
    """All orders as already-clean canonical lead rows (typed), for scoring queries."""
    f = lead_facts(orders)
    return f.select(
        "executive", "lead_id",
        F.lit(True).alias("has_inbound"),
        F.col("out_ts").isNotNull().alias("has_outbound"),
        F.to_date("in_ts").alias("in_date"), F.date_format("in_ts", "HH:mm:ss").alias("in_time"),
        F.to_date("out_ts").alias("out_date"), F.date_format("out_ts", "HH:mm:ss").alias("out_time"),
        F.lit(None).cast("string").alias("response_time"),
        F.lit(None).cast("string").alias("score"),
        F.lit(None).cast("string").alias("entry_segment"),
        F.col("source_rank"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("source_file"),
    )


# ---------------------------------------------------------------- B4 schedule sheet
def schedule_sheet(leads: DataFrame, date_col: str = "in_date") -> DataFrame:
    """A weekly shift sheet covering every week that has leads.

    Per week: a header row (Monday..Saturday; every 29th week reversed), one
    row per operator with a shift text, an extra afternoon row for one
    operator every third week, and an exact repeat of a row every fourth
    week. One operator row precedes any header and must be ignored.
    """
    spark = leads.sparkSession
    weeks = leads.select(F.to_date(F.date_trunc("week", F.col(date_col))).alias("ws")).where(
        F.col("ws").isNotNull()).distinct()
    wk = (F.datediff(F.col("ws"), F.lit(_dt.date(1970, 1, 5))) / 7).cast("bigint")
    ws, we = F.col("ws"), F.date_add(F.col("ws"), 5)
    rev = wk % 29 == 3
    texts = F.array(*[F.lit(t) for t in SHEET_SHIFT_TEXTS])

    def text_at(i):
        return F.element_at(texts, ((wk + i) % len(SHEET_SHIFT_TEXTS) + 1).cast("int"))

    rows = [F.struct(F.lit(0).cast("bigint").alias("j"),
                     F.when(rev, _iso(we)).otherwise(_iso(ws)).alias("c0"),
                     F.when(rev, F.date_format(ws, "d/M/yyyy")).otherwise(F.date_format(we, "d/M/yyyy")).alias("c1"),
                     F.lit(None).cast("string").alias("c2"))]
    for i, name in enumerate(SHEET_OPERATORS):
        rows.append(F.struct(F.lit(i + 1).cast("bigint").alias("j"), F.lit(name).alias("c0"),
                             F.lit(None).cast("string").alias("c1"), text_at(i).alias("c2")))
    rows.append(F.struct(F.lit(6).cast("bigint").alias("j"),
                         F.when(wk % 3 == 0, F.lit("agent_b")).alias("c0"),
                         F.lit(None).cast("string").alias("c1"), F.lit("Tarde").alias("c2")))
    rows.append(F.struct(F.lit(7).cast("bigint").alias("j"),
                         F.when(wk % 4 == 0, F.lit("agent_d")).alias("c0"),
                         F.lit(None).cast("string").alias("c1"), text_at(3).alias("c2")))
    sheet = weeks.select(wk.alias("wk"), F.explode(F.array(*rows)).alias("r")).select(
        F.lit(SHEET_NAME).alias("sheet"), (F.col("wk") * 10 + F.col("r.j")).alias("row_no"),
        F.col("r.c0").alias("c0"), F.col("r.c1").alias("c1"), F.col("r.c2").alias("c2"))
    stray = spark.createDataFrame([(SHEET_NAME, -1, "agent_a", None, "Mañana")],
                                  "sheet string, row_no bigint, c0 string, c1 string, c2 string")
    return sheet.unionByName(stray)


# ---------------------------------------------------------------- B7 capture log
def capture_log(events: DataFrame) -> DataFrame:
    """One row per chat of an earlier collection run (contacts with user_id % 4 != 0)."""
    uid = F.col("user_id")
    per = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("messages"))
    status = (F.when(uid % 9 == 0, F.lit("timed_out")).when(uid % 13 == 0, F.lit("error"))
              .when(uid % 17 == 0, F.lit("excluded")).otherwise(F.lit("ok")))
    return per.where(uid % 4 != 0).select(
        F.concat(F.lit("contact "), uid.cast("string")).alias("contact"), status.alias("status"),
        F.when(status.isin("ok", "timed_out"), F.col("messages")).otherwise(F.lit(0)).cast("bigint").alias("messages"))


# ---------------------------------------------------------------- B9 stored chat pages
def chat_pages(conversations: DataFrame) -> DataFrame:
    """conversations -> one stored chat page each (page_id, html): bubbles with nested elements of one name, the meta on
    an inner element, comments, unclosed tags, and markers by ``turn % 5`` (0: audio with a meta, 1: an
    attachment without meta, 2: a picture alone, others: text)."""
    text, kind = F.translate(F.coalesce("text", F.lit("")), "<>&", "   "), F.col("turn") % 5
    head = F.concat(F.lit('<div class="in" data-pre-plain-text="[turn '), F.col("turn").cast("string"), F.lit('] x > y: ">'))
    body = (F.when(kind == 0, F.concat(head, F.lit("</div><span data-icon='audio-play'></span>")))
            .when(kind == 1, F.concat(F.lit("<div><span>"), F.substring(text, 1, 20), F.lit('</span></div><b ROLE=button aria-label="Descargar archivo"></b>')))
            .when(kind == 2, F.lit('<div><div><img src="x.png"></div></div>'))
            .otherwise(F.concat(head, F.lit("<p><span>"), F.substring(text, 1, 3), F.lit("</span><div><!-- <div>no -->"),
                                F.substring(text, 4, 1_000_000), F.lit("</div></div>"))))
    bubble = F.concat(F.lit("<div role=row><i>"), body, F.lit("</div>\n"))
    return conversations.groupBy(F.col("conv_id").alias("page_id")).agg(
        F.concat(F.lit("<script>var a = '<div role=row>';</script><div>"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", bubble.alias("b")))), lambda x: x["b"]), ""),
                 F.lit("</div>")).alias("html"))
