"""CSV scans over pathological local files (written by the test, invented values)."""

import datetime as dt
import os

import pytest

from replylens.sources.csv_scan import header_groups, read_chat_export, read_history, read_inbox_export, read_new_leads

AS_OF = dt.date(2026, 1, 22)
BOM = "\ufeff"


def write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write((BOM if bom else "") + text)


def test_mixed_headers_bom_empty_and_case(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/a.csv", "Ejecutivo,ID_LEAD,Fecha Entrante,Hora Entrante\nagent_a,1,hoy,09:30\n", bom=True)
    write(f"{d}/b.CSV", "Hora Entrante,lead_id,Ejecutivo,Fecha Entrante,Extra\n10:00:00.5,2,agent_b,3/1/2024,z\n")
    write(f"{d}/sub/c.csv", "ID_LEAD,Ejecutivo,Fecha Entrante\n3,agent_c,nan\n")
    write(f"{d}/empty.csv", "")
    write(f"{d}/header_only.csv", "Ejecutivo,ID_LEAD\n")
    write(f"{d}/unrelated.csv", "foo,bar\n1,2\n")
    write(f"{d}/notes.txt", "Ejecutivo,ID_LEAD\nx,9\n")
    groups = header_groups(spark, d)
    assert len(groups) == 5   # empty file has no header; .txt is not scanned
    out = read_new_leads(spark, [d, f"{d}/does-not-exist"], AS_OF)
    rows = {r["lead_id"]: r for r in out.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"]["executive"], rows["1"]["in_date"], rows["1"]["in_time"]) == ("agent_a", AS_OF, "09:30")
    assert (rows["2"]["executive"], rows["2"]["in_date"]) == ("agent_b", dt.date(2024, 1, 3))
    assert rows["3"]["in_date"] is None and rows["3"]["source_file"] == "c.csv"


def test_history_must_not_be_empty(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/h.csv", "Ejecutivo,ID_LEAD,Fecha Entrante\n")
    with pytest.raises(ValueError):
        read_history(spark, d)


def test_history_roundtrip_labels(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/h.csv", "Ejecutivo,ID_LEAD,Mensaje Entrante,Mensaje Saliente,Fecha Entrante,Hora Entrante,"
                        "Fecha Saliente,Hora Saliente,Tiempo Respuesta (min),Score Tiempo Respuesta,"
                        "Segmento Horario Entrada\n"
                        "agent_a,4228.0,SI,SI,2026-01-22,09:30:00,2026-01-22,09:35:00,00:05:00,🟢 Excelente,"
                        "☀️ Mañana laborable\n", bom=True)
    r = read_history(spark, d).first()
    assert (r["lead_id"], r["score"], r["entry_segment"], r["has_outbound"]) == ("4228", "excellent", "morning_work", True)


def test_inbox_scan_skips_bad_files(spark, tmpdir_fresh):
    d = tmpdir_fresh
    head = "conversation_id,inbox_id,sender_type,sent_at,contact_name,content\n"
    write(f"{d}/good.csv", head + "1,0,Contact,2024-01-01 15:00:00,c,hi\n1,0,User,2024-01-01 15:05:00,c,ok\n")
    write(f"{d}/bad.csv", head + "2,0,Contact,2024-01-01 15:00:00,c,hi\n2,0,User,yesterday,c,ok\n")
    write(f"{d}/nosent.csv", "conversation_id,inbox_id\n3,0\n")
    msgs = read_inbox_export(spark, d)
    assert sorted(r["conversation_id"] for r in msgs.collect()) == ["1", "1"]


def test_chat_export_executive_from_file_name(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/agent_q.csv", 'contact,meta,text\nc1,"[9:00, 3/1/2024] c1:",hola\nc1,NA,""\n', bom=True)
    rows = read_chat_export(spark, d).collect()
    assert [r["executive"] for r in rows] == ["agent_q", "agent_q"]
    assert rows[1]["meta"] == "NA"    # no NA tokens in chat exports


def test_schedule_sheet_file(spark, tmpdir_fresh):
    from replylens.dims import dim_alias, dim_shift, dim_shift_rule
    from replylens.operators.schedule import expand_schedule
    from replylens.sources.csv_scan import read_schedule_sheet
    d = tmpdir_fresh
    write(f"{d}/weeks.csv", "agent_a,,Mañana\n2024-01-08,13/1/2024,\nagent_a,,Mañana\nAgent B,,turno tarde\n"
                           "2024-01-15,20/1/2024,\nagent_a,,TARDE\n", bom=True)
    sheet = read_schedule_sheet(spark, d)
    rows = sheet.orderBy("row_no").collect()
    assert [r["c0"] for r in rows][:2] == ["agent_a", "2024-01-08"]          # BOM gone, file order kept
    assert rows[0]["sheet"].endswith("/weeks") and rows[1]["c2"] is None
    sched = expand_schedule(sheet, dim_shift_rule(spark), dim_shift(spark), dim_alias(spark))
    got = {(r["executive"], r["fecha"].isoformat(), r["hora_inicio"]) for r in sched.collect()}
    assert ("agent_a", "2024-01-08", "09:00") in got and ("agent_a", "2024-01-13", "09:00") in got
    assert ("agent_b", "2024-01-13", "14:00") in got
    assert ("agent_a", "2024-01-15", "14:00") in got and ("agent_a", "2024-01-17", "07:15") in got
    assert len([g for g in got if g[0] == "agent_a"]) == 12   # two weeks Mon-Sat; the stray first row is ignored


def test_write_messages_header_order_and_empty_guard(spark, tmpdir_fresh):
    from replylens.operators.capture import capture_summary, chats_with_status
    from replylens.sinks import write_messages
    d = tmpdir_fresh
    msgs = spark.createDataFrame([("x", "[9:00, 3/1/2024] c:", "hi", "c1")], "text string, meta string, kind string, contact string")
    assert write_messages(msgs, f"{d}/out")
    parts = [f for f in os.listdir(f"{d}/out") if f.endswith(".csv")]
    with open(f"{d}/out/{parts[0]}", encoding="utf-8") as f:
        assert f.readline().strip() == "contact,meta,text"
    assert not write_messages(msgs.limit(0), f"{d}/empty") and not os.path.exists(f"{d}/empty")
    log = spark.createDataFrame([("a", "ok", 3), ("b", "timed_out", 1), ("c", "timed_out", 2)],
                                "contact string, status string, messages bigint")
    assert sorted(r["contact"] for r in chats_with_status(log).collect()) == ["b", "c"]
    total = [r for r in capture_summary(log).collect() if r["is_total"]][0]
    assert (total["chats"], total["messages"]) == (3, 6)


def test_file_names_and_bad_files(spark, tmpdir_fresh):
    """Files are named after people; one odd file never fails the scan."""
    import os

    from replylens.sources.csv_scan import read_chat_export, scan_csv
    names = ["Ana María.csv", "50% #1 + José.csv", "a[b]{c}.csv"]
    for i, n in enumerate(names):
        with open(os.path.join(tmpdir_fresh, n), "w", encoding="utf-8") as f:
            f.write(f'contact,meta,text\nc{i},m,"said ""hi"", ok\nline two"\n')
    rows = read_chat_export(spark, tmpdir_fresh).collect()
    assert {(r["executive"], r["contact"]) for r in rows} == {(n[:-4], f"c{i}") for i, n in enumerate(names)}
    assert {r["text"] for r in rows} == {'said "hi", ok\nline two'}
    with open(os.path.join(tmpdir_fresh, "twice.csv"), "w") as f:
        f.write("x,X,\n1,2,3\n")
    frames = {tuple(c for c in d.columns if not c.startswith("_")): d.count() for d in scan_csv(spark, tmpdir_fresh)}
    assert frames[("x", "X.1")] == 1


def test_sinks_round_trip_hostile_cells(spark, tmpdir_fresh):
    from replylens.operators.leads import coerce_history
    from replylens.sinks import write_by_executive, write_lead_csv
    from replylens.sources.csv_scan import read_history
    schema = ", ".join(f"`{c}` string" for c in ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante",
                                                  "Hora Entrante", "Fecha Saliente", "Hora Saliente", "Notas"])
    h = coerce_history(spark.createDataFrame([('Ana "Sol", Lima', "1", "SI", "NO", "2024-01-02", "10:00:00", None, None, 'x, "y" \\ z'),
                                              ("Ana-P", "2", "SI", "NO", "2024-01-02", "10:00:00", None, None, None),
                                              ("Ana P", "3", "SI", "NO", "2024-01-02", "10:00:00", None, None, "n")], schema))
    path = write_lead_csv(h, tmpdir_fresh + "/out")
    back = {r["lead_id"]: (r["executive"], r["Notas"]) for r in read_history(spark, path).collect()}
    assert back == {"1": ('Ana "Sol", Lima', 'x, "y" \\ z'), "2": ("Ana-P", None), "3": ("Ana P", "n")}
    for _ in range(2):
        write_by_executive(h, tmpdir_fresh + "/by", "2024-01-03")
    by = spark.read.option("header", True).option("escape", '"').csv(tmpdir_fresh + "/by")
    assert by.count() == 3 and by.select("executive").distinct().count() == 3


def test_header_of_any_length(spark, tmpdir_fresh):
    names = [f"own column {i}" for i in range(12_000)] + ["ID_LEAD"]
    write(f"{tmpdir_fresh}/wide.csv", ",".join(names) + "\n" + ",".join(["x"] * 12_000) + ",77\n", bom=True)
    write(f"{tmpdir_fresh}/b.csv", "ID_LEAD,Ejecutivo\n78,agent_a\n")
    assert sorted(r["lead_id"] for r in read_new_leads(spark, tmpdir_fresh, AS_OF).collect()) == ["77", "78"]


def test_line_breaks_in_lead_and_history_cells(spark, tmpdir_fresh):
    d = tmpdir_fresh
    write(f"{d}/new/a.csv", 'Ejecutivo,ID_LEAD,Fecha Entrante\r\n"Ana\nMaría",7,2024-01-01\r\nAna,8,2024-01-02\r\n')
    write(f"{d}/new/b.csv", 'Ejecutivo,ID_LEAD,Fecha Entrante\nBea,9,2024-01-03\n')
    got = {r["lead_id"]: (r["executive"], r["in_date"]) for r in read_new_leads(spark, f"{d}/new", AS_OF).collect()}
    assert got == {"7": ("Ana\nMaría", dt.date(2024, 1, 1)), "8": ("Ana", dt.date(2024, 1, 2)), "9": ("Bea", dt.date(2024, 1, 3))}
    write(f"{d}/h/h.csv", 'Ejecutivo,ID_LEAD,Notas\nAna,1,"one\n\ntwo, ""three"""\nBea,2,plain\n"Cea",3,"x\r\ny"\n', bom=True)
    notes = {r["lead_id"]: r["Notas"] for r in read_history(spark, f"{d}/h").collect()}
    assert notes == {"1": 'one\n\ntwo, "three"', "2": "plain", "3": "x\r\ny"}


def test_nothing_usable_is_an_empty_frame(spark, tmpdir_fresh):
    from replylens import schema as S
    write(f"{tmpdir_fresh}/x.csv", "foo,bar\n1,2\n")
    for folder in (tmpdir_fresh, f"{tmpdir_fresh}/none"):
        out = read_new_leads(spark, folder, AS_OF)
        assert out.count() == 0 and out.columns == S.LEAD_SCHEMA.fieldNames()


def test_text_conversation_ids(spark, tmpdir_fresh):
    head = "conversation_id,inbox_id,sender_type,sent_at,contact_name,content\n"
    write(f"{tmpdir_fresh}/a.csv", head + "A-7,0,Contact,2024-01-01 15:00:00,c,hi\nA-8,0,User,2024-01-01 15:05:00,c,ok\n12.0,0,User,2024-01-01 15:05:00,c,ok\n")
    assert sorted(r["conversation_id"] for r in read_inbox_export(spark, tmpdir_fresh).collect()) == ["12", "A-7", "A-8"]


def test_own_columns_named_like_the_scan_s(spark, tmpdir_fresh):
    from replylens.sources.csv_scan import FILE, PATH, scan_csv
    write(f"{tmpdir_fresh}/a.csv", f"_file,_path,{FILE},{PATH},x\n1,2,3,4,5\n")
    row = scan_csv(spark, tmpdir_fresh)[0].first().asDict()
    assert [row[c] for c in ("_file", "_path", f"{FILE}.1", f"{PATH}.1", "x", FILE)] == ["1", "2", "3", "4", "5", "a.csv"]


def test_many_files_are_profiled_in_one_job(spark, tmpdir_fresh):
    for i in range(300):
        write(f"{tmpdir_fresh}/f{i}.csv", "a,b\n1,2\n" if i % 2 else '"a\nz",b\n1,"2\n3"\n')
    groups = header_groups(spark, tmpdir_fresh)
    assert [(h, broken, len(f)) for h, broken, f in groups] == [('"a\nz",b', True, 150), ("a,b", False, 150)]


def records_of(spark, folder, split_bytes):
    from replylens.sources.csv_records import records, text_lines
    from replylens.sources.csv_scan import _list_files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        rows = records(text_lines(spark, _list_files(spark, [folder], ".csv", True))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return sorted(rows, key=lambda r: (r["path"], r["block"], r["pos"]))


@pytest.mark.parametrize("split_bytes", [40, 300, 1 << 20])
def test_records_are_whole_wherever_files_are_split(spark, tmpdir_fresh, split_bytes):
    """Random cells with quotes, separators and line breaks, against Python's csv reader."""
    import csv
    import io
    import random
    rng = random.Random(split_bytes)
    want = {}
    for k in range(3):
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\r\n" if k == 1 else "\n")
        rows = [["".join(rng.choice(['"', ",", "\n", "a", "é", " ", "bc", '""', "\n\n"]) for _ in range(rng.randrange(9))) or "x" for _ in range(3)]
                for _ in range(60)]
        w.writerows(rows)
        write(f"{tmpdir_fresh}/f{k}.csv", out.getvalue(), bom=k == 2)
        want[f"f{k}.csv"] = rows
    got = {}
    for r in records_of(spark, tmpdir_fresh, split_bytes):
        cells = next(csv.reader(io.StringIO(r["record"], newline="")))
        rows = got.setdefault(r["path"].rsplit("/", 1)[1], [])
        assert r["first"] == (not rows)
        rows.append(cells)
    assert got == want


def test_quotes_inside_plain_cells_open_nothing(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/a.csv", 'a,b\n5" pipe,say "hi\n"x, ""y""",2\n"",z"\n')
    ((_, broken, _),) = header_groups(spark, tmpdir_fresh)
    assert not broken
    assert [r["record"] for r in records_of(spark, tmpdir_fresh, 1 << 20)] == ["a,b", '5" pipe,say "hi', '"x, ""y""",2', '"",z"']


def test_snapshots_of_one_run_score_the_leads_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from replylens.operators.leads import build_leads, coerce_history
    from replylens.plans import sinks
    cols = ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante", "Hora Entrante", "Fecha Saliente", "Hora Saliente"]
    rows = [(f"agent_{i % 3}", str(i), "SI", "SI" if i % 2 else "NO", "2024-01-02", "10:00:00", *(("2024-01-02", "10:05:00") if i % 2 else (None, None)))
            for i in range(30)]
    leads = build_leads(coerce_history(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))), None)
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x
    monkeypatch.setattr(sinks, "scored_leads", lambda *_: leads.withColumn("lead_id", F.udf(counted, "string").asNondeterministic()("lead_id")))
    got = {r["lead_id"]: (r["executive"], r["response_time"]) for r in sinks.q_lead_csv_roundtrip(spark, "").collect()}
    assert got == {str(i): (f"agent_{i % 3}", "00:05:00" if i % 2 else None) for i in range(30)}
    assert seen.value == 30


def test_profile_holds_no_lines(spark, tmpdir_fresh):
    """No sort or sorted aggregate in the stages that scan the files; heads are right wherever files share a task or repeat lines."""
    from replylens.sources.csv_records import file_profile
    from replylens.sources.csv_scan import _list_files
    write(f"{tmpdir_fresh}/a.csv", "x,y\n1,2\nx,y\nx,y\n")
    write(f"{tmpdir_fresh}/b.csv", "z\n" * 50, bom=True)
    write(f"{tmpdir_fresh}/c.csv", '\nx,y\n1,"2\n3"\n')
    write(f"{tmpdir_fresh}/d.csv", "y,x\r\n")
    heads = file_profile(spark, _list_files(spark, [tmpdir_fresh], ".csv", True))
    stages = heads._jdf.queryExecution().executedPlan().toString().split("Exchange")
    scans = [s for s in stages if "FileScan text" in s]
    assert scans and not any("Sort" in s for s in scans)
    assert {r["path"][-5:]: (r["head"], r["broken"]) for r in heads.collect()} == {
        "a.csv": ("x,y", False), "b.csv": ("z", False), "c.csv": ("", True), "d.csv": ("y,x", False)}
