"""Operator semantics on small hand-made fixtures (invented names only)."""

import datetime as dt

from pyspark.sql import functions as F

from replylens.dims import dim_alias, dim_inbox, dim_owner, dim_shift, dim_shift_rule
from replylens.operators.capture import apply_capture_policy, dedupe_messages, eligible_chats, page_nodes
from replylens.operators.chats import chat_first_response, parse_chat_export
from replylens.operators.inbox import inbox_first_response
from replylens.operators.leads import (build_leads, coerce_history, consolidate, dedupe_leads, prepare_new_leads,
                                       score_leads)
from replylens.operators.schedule import expand_schedule, in_shift, off_shift, shift_windows

T = dt.datetime


def chat(spark, rows):
    raw = spark.createDataFrame(rows, "executive string, contact string, meta string, text string")
    return parse_chat_export(raw)


def test_chat_three_shapes(spark):
    rows = [
        # contact first, owner replies in a later minute (an owner line in the same minute is ignored)
        ("agent_a", "c1", "[9:00, 3/1/2024] c1:", "hi"),
        ("agent_a", "c1", "[9:00, 3/1/2024] You:", "auto"),
        ("agent_a", "c1", "[9:07, 3/1/2024] agent_a:", "hello"),
        # contact only
        ("agent_a", "c2", "[10:00, 3/1/2024] c2:", "hi"),
        # owner first
        ("agent_a", "c3", "[11:00, 3/1/2024] Tú:", "promo"),
        ("agent_a", "c3", "[11:05, 3/1/2024] c3:", "?"),
        # unparsable rows vanish
        ("agent_a", "c4", "", "[AUDIO]"),
    ]
    out = {r["lead_id"]: r for r in chat_first_response(chat(spark, rows), dim_owner(spark)).collect()}
    assert set(out) == {"c1", "c2", "c3"}
    assert (out["c1"]["has_inbound"], out["c1"]["has_outbound"], out["c1"]["out_time"]) == (True, True, "09:07:00")
    assert (out["c2"]["has_inbound"], out["c2"]["has_outbound"], out["c2"]["out_date"]) == (True, False, None)
    assert (out["c3"]["has_inbound"], out["c3"]["has_outbound"], out["c3"]["in_time"], out["c3"]["out_time"]) == \
        (False, True, None, "11:00:00")


def inbox(spark, rows):
    return spark.createDataFrame(rows, "message_id bigint, conversation_id bigint, inbox_id bigint, "
                                       "sender_type string, sent_at timestamp_ntz, contact_name string, content string")


def test_inbox_reply_policies(spark):
    sys_msg = "Asignado a X por Automation System"
    rows = [
        # system row first, then the agent: agent row is first real AND the reply (0 s) under the reference policy
        (1, 10, 0, "User", T(2024, 1, 1, 14, 0), "c", sys_msg),
        (2, 10, 0, "User", T(2024, 1, 1, 14, 1), "c", "hola"),
        (3, 10, 0, "Contact", T(2024, 1, 1, 14, 2), "c", "?"),
        (4, 10, 0, "User", T(2024, 1, 1, 14, 5), "c", "ok"),
        # group conversation is dropped
        (5, 11, 1, "Contact", T(2024, 1, 1, 15, 0), "team (GROUP) ", "x"),
        # unknown inbox is dropped
        (6, 12, 9, "Contact", T(2024, 1, 1, 15, 0), "d", "x"),
        # only system rows: dropped
        (7, 13, 1, "User", T(2024, 1, 1, 15, 0), "e", sys_msg),
    ]
    ref = {r["lead_id"]: r for r in inbox_first_response(inbox(spark, rows), dim_inbox(spark)).collect()}
    assert set(ref) == {"10"}
    r = ref["10"]
    assert r["executive"] == "agent_a" and r["has_inbound"] is False
    assert (r["in_time"], r["out_time"]) == ("09:01:00", "09:01:00")   # -5 h; reply = the same agent row
    strict = inbox_first_response(inbox(spark, rows), dim_inbox(spark), reply_policy="strict").collect()
    assert strict[0]["out_time"] == "09:05:00"
    win = inbox_first_response(inbox(spark, rows), dim_inbox(spark), since="2024-01-02").collect()
    assert win == []


def lead_rows(spark, rows):
    cols = ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante", "Hora Entrante",
            "Fecha Saliente", "Hora Saliente", "source_file"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def hist_rows(spark, rows):
    cols = ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante", "Hora Entrante",
            "Fecha Saliente", "Hora Saliente", "Tiempo Respuesta (min)", "Score Tiempo Respuesta",
            "Segmento Horario Entrada", "source_file"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_documented_example_row(spark):
    """The documented example: 'hoy' 09:30 -> 09:35 gives 00:05:00, excellent, working morning."""
    new = lead_rows(spark, [("agent_k", "12345", "SI", "SI", "hoy", "09:30:00", "hoy", "09:35:00", "f.csv")])
    hist = hist_rows(spark, [("agent_z", "1", "SI", "NO", "2026-01-01", "10:00:00", None, None, None, None, None, "h")])
    out = {r["lead_id"]: r for r in build_leads(coerce_history(hist), prepare_new_leads(new, dt.date(2026, 1, 22))).collect()}
    r = out["12345"]
    assert (r["in_date"], r["response_time"], r["score"], r["entry_segment"]) == \
        (dt.date(2026, 1, 22), "00:05:00", "excellent", "morning_work")
    assert out["1"]["score"] == "not_answered"


def test_dedupe_history_first_and_idempotent(spark):
    hist = hist_rows(spark, [("agent_b", "7", "SI", "NO", "2024-01-02", "10:00:00", None, None, None, None, None, "h")])
    new = lead_rows(spark, [
        ("agent_b", "7", "SI", "SI", "2024-01-01", "09:00:00", "2024-01-01", "09:10:00", "n.csv"),
        ("agent_a", "7.0", "SI", "SI", "2024-01-05", "09:00:00", "2024-01-05", "09:10:00", "n.csv"),
        ("agent_c", None, "SI", "SI", "2024-01-05", "09:00:00", "2024-01-05", "09:10:00", "n.csv"),
    ])
    merged = consolidate(coerce_history(hist), prepare_new_leads(new, dt.date(2026, 1, 22)))
    once = dedupe_leads(merged)
    rows = once.collect()
    assert len(rows) == 1                       # null id dropped; '7.0' == '7'
    assert rows[0]["executive"] == "agent_a"    # executive sorts first
    twice = dedupe_leads(once.unionByName(once))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, rows))


def test_response_and_scores(spark):
    hist = hist_rows(spark, [
        ("e", "1", "SI", "SI", "2024-01-01", "10:00:00", "2024-01-01", "09:00:00", None, None, None, "h"),  # outbound
        ("e", "2", "SI", "SI", "2024-01-01", "10:00:00", "2024-01-03", "10:00:00", "30:00:00", None, None, "h"),
        ("e", "3", "SI", "SI", "2024-01-01", "10:00:00", "2024-01-01", "10:00:30", "00:00:30", "🔴 Lento", None, "h"),
        ("e", "4", "NO", "SI", None, None, "2024-01-01", "10:00:00", None, None, None, "h"),  # owner first
    ])
    out = {r["lead_id"]: r for r in score_leads(coerce_history(hist)).collect()}
    assert out["1"]["score"] == "outbound" and out["1"]["response_time"] is None
    assert (out["2"]["response_time"], out["2"]["score"], out["2"]["response_seconds"]) == ("48:00:00", "very_slow", 172800)
    assert out["3"]["score"] == "slow"          # existing score kept when the time was not recomputed
    assert out["4"]["score"] is None and out["4"]["entry_segment"] == "not_registered"
    owner_first = {r["lead_id"]: r for r in score_leads(coerce_history(hist), score_owner_first=True).collect()}
    assert owner_first["4"]["score"] == "outbound"


def sheet(spark, rows):
    return spark.createDataFrame(rows, "sheet string, row_no bigint, c0 string, c1 string, c2 string")


def test_schedule_expansion_and_shift_membership(spark):
    s = sheet(spark, [
        ("s", 0, "agent_b", None, "Mañana"),              # before any header: ignored
        ("s", 1, "1998-08-17", "23/8/1998", None),        # Monday..Sunday
        ("s", 2, "AGENT_A", None, "turno tarde"),         # alias -> agent_a
        ("s", 3, "agent_e", None, "MANANA"),
        ("s", 4, "agent_d", None, "libre"),               # unknown word: ignored
        ("s", 5, "1998-08-30", "24/8/1998", None),        # reversed week: no rows
        ("s", 6, "agent_b", None, "Tarde"),
    ])
    sched = expand_schedule(s, dim_shift_rule(spark), dim_shift(spark), dim_alias(spark))
    rows = sched.collect()
    day = lambda n: dt.date(1998, 8, n)
    by = {(r["executive"], r["fecha"]): (r["hora_inicio"], r["hora_fin"]) for r in rows}
    assert {r["executive"] for r in rows} == {"agent_a", "agent_e"}
    assert not any(d == day(23) for _, d in by)           # Sunday
    assert ("agent_e", day(18)) not in by                 # that person's closed date
    assert by[("agent_e", day(20))] == ("10:20", "12:45")
    assert by[("agent_e", day(17))] == ("09:00", "18:00")
    assert by[("agent_a", day(19))] == ("07:15", "11:45")  # person and weekday
    assert by[("agent_a", day(21))] == ("14:00", "22:00")  # person and shift beats weekday and shift
    windows = shift_windows(sched)
    leads = spark.createDataFrame([
        ("agent_e", "1", day(20), "10:20:00"), ("agent_e", "2", day(20), "12:45:00"),
        ("agent_e", "3", day(20), "12:45:01"), ("agent_x", "4", day(20), "11:00:00"),
        ("agent_e", "5", day(20), None),
    ], "executive string, lead_id string, in_date date, in_time string")
    inside = {r["lead_id"] for r in in_shift(leads, windows).collect()}
    outside = {r["lead_id"] for r in off_shift(leads, windows).collect()}
    assert inside == {"1", "2"} and outside == {"3", "4", "5"}


def test_rules_need_no_nested_loop(spark):
    s = sheet(spark, [("s", 1, "1998-08-17", "22/8/1998", None), ("s", 2, "agent_e", None, "Tarde")])
    plan = expand_schedule(s, dim_shift_rule(spark), dim_shift(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_schedule_gives_empty_frame(spark):
    s = sheet(spark, [("s", 1, "x", None, "libre")])
    out = expand_schedule(s, dim_shift_rule(spark), dim_shift(spark))
    assert out.count() == 0 and "inicio_dt" in out.columns


def test_message_rules(spark):
    msgs = spark.createDataFrame([
        ("c1", "[9:00, 3/1/2024] c1:", "hi", None, None),
        ("c1", "[9:00, 3/1/2024] c1:", "hi", None, None),
        ("c1", "", "", None, None),
        ("c1", "", "", "AUDIO", "0:07"),
        ("c1", "", "", "AUDIO", "0:09"),
        ("c1", "", "", "ADJUNTO", "photo"),
    ], "contact string, meta string, text string, kind string, raw_text string")
    out = sorted(map(tuple, dedupe_messages(msgs).collect()))
    assert out == [("c1", "", "[ADJUNTO]"), ("c1", "", "[AUDIO]"), ("c1", "", "[AUDIO]"),
                   ("c1", "[9:00, 3/1/2024] c1:", "hi")]
    titles = spark.createDataFrame([("Ana",), ("  ana  ",), ("Bo",), ("Archivados",)], "contact string")
    ex = spark.createDataFrame([("ANA",)], "title string")
    assert {r["title"] for r in eligible_chats(titles, ex).collect()} == {"Bo"}
    log = spark.createDataFrame([("a", "ok", 2), ("b", "timed_out", 1), ("c", "error", 0)],
                                "contact string, status string, messages bigint")
    m = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "contact string, x int")
    log = log.unionByName(log)                                  # a chat logged twice counts once
    assert sorted(r["contact"] for r in apply_capture_policy(m, log, False).collect()) == ["a", "c", "d"]
    assert sorted((r["contact"], r["partial"]) for r in apply_capture_policy(m, log, True).collect()) == \
        [("a", False), ("b", True), ("c", False), ("d", False)]


def test_page_nodes(spark):
    pages = spark.createDataFrame([(1, '<p><a href="/x">X</a> <a class="k" href="/y.ogg"></a>'
                                       "<A HREF='/z'><b>Z</b> z</A><a data-href=\"/no\">n</a></p>"
                                       '<div data-meta="[9:00] Ana:"><span>Hi</span> there</div>')],
                                  "page_id bigint, html string")
    rows = page_nodes(pages).orderBy("pos").collect()
    assert [(r["value"], r["text"]) for r in rows] == [("/x", "X"), ("/y.ogg", ""), ("/z", "Z z")]
    rows = page_nodes(pages, "data-meta", tag=None).collect()
    assert [(r["value"], r["text"]) for r in rows] == [("[9:00] Ana:", "Hi there")]


def test_page_nodes_nest(spark):
    pages = spark.createDataFrame([(1, '<div data-m=out>a<!-- <div data-m="no"> --><div data-m=\'in > x\'>b<br>c</div></span> d<p>e</div>'
                                       '<div title=" data-m=no" >f</div><span data-m="g"/>h<DIV DATA-M="open">i<script>if (a < b) "</div>"</script> j < k')],
                                  "page_id bigint, html string")
    rows = page_nodes(pages, "data-m", tag=None).orderBy("pos").collect()
    assert [(r["pos"], r["value"], r["text"]) for r in rows] == [
        (0, "out", "abc de"), (1, "in > x", "bc"), (2, "g", ""), (3, "open", "i j < k")]
    deep = spark.createDataFrame([(1, "<div data-m=x>" * 2000 + "t" + "</div>" * 2000)], "page_id bigint, html string")
    rows = page_nodes(deep, "data-m", tag="div").collect()
    assert len(rows) == 2000 and {r["text"] for r in rows} == {"t"}


def test_bubbles_and_media_kinds(spark):
    from replylens.operators.capture import chat_page_messages
    html = ('<div role="row"><div><div data-pre-plain-text="[9:00] Ana: "><span>Hi</span> there</div></div></div>'
            '<div role="row"><div data-pre-plain-text="[9:01] Ana: "></div><span data-icon="ptt-play"></span>0:12</div>'
            '<div role="row"><span role="button" aria-label="Abrir foto grande"></span></div>'
            '<div role="row"><span aria-label="Download"></span>no button</div>'
            '<div role="row"><img src="a"><b> </b></div><div role="row">only text<img src="a"></div>')
    got = chat_page_messages(spark.createDataFrame([(1, html)], "page_id bigint, html string")).orderBy("pos").collect()
    assert [(r["meta"], r["text"], r["kind"], r["raw_text"]) for r in got] == [
        ("[9:00] Ana:", "Hi there", None, "Hi there"), ("[9:01] Ana:", "", "AUDIO", "0:12"), ("[9:01] Ana:", "", None, ""),
        ("", "", "ADJUNTO", ""), ("", "", "ADJUNTO", "")]


def test_forward_fill_in_blocks(spark):
    from replylens.operators.schedule import sheet_operator_rows
    rows, want, week = [], [], None
    for i in range(60):
        if i in (4, 5, 26):
            week = f"2024-01-{i + 1:02d}"
            rows.append(("s", i, week, week, None))
        else:
            rows.append(("s", i, f"agent_{i}", None, "Tarde"))
            want += [(i, week)] if week else []
    sheet = spark.createDataFrame(rows + [("t", 1, "agent_x", None, "Tarde")], "sheet string, row_no bigint, c0 string, c1 string, c2 string")
    for block in (1, 7, 1000):
        got = sheet_operator_rows(sheet, block).orderBy("row_no").collect()
        assert [(r["row_no"], r["week_start"].isoformat()) for r in got] == want


def test_dedupe_keep_latest_answer(spark):
    new = lead_rows(spark, [
        ("agent_a", "9", "SI", "NO", "2024-01-01", "09:00:00", None, None, "a.csv"),
        ("agent_b", "9", "SI", "SI", "2024-01-01", "09:00:00", "2024-01-02", "10:00:00", "b.csv"),
        ("agent_c", "9", "SI", "SI", "2024-01-01", "09:00:00", "2024-01-05", "08:00:00", "c.csv"),
    ])
    rows = prepare_new_leads(new, dt.date(2026, 1, 22))
    assert dedupe_leads(rows).first()["executive"] == "agent_a"                       # export order
    assert dedupe_leads(rows, keep="latest_answer").first()["executive"] == "agent_c"  # latest reply
