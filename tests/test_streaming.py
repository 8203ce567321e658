"""Streaming operators: results do not depend on how input is cut into micro-batches,
and closed sessions agree with the batch rule."""

import datetime as dt

from pyspark.sql import functions as F

from replylens.session import scratch_path
from replylens.streaming import dedupe_stream, first_response_stream, run_available

T = dt.datetime


def rows():
    out = []
    for c in range(6):
        base = T(2024, 1, 1 + c, 9, 0)
        out += [
            (f"agent_{c % 2}", f"c{c}", f"m{c}", "hi", "contact", base),
            (f"agent_{c % 2}", f"c{c}", f"m{c}", "hi", "contact", base),          # repeat
            (f"agent_{c % 2}", f"c{c}", f"o{c}", "ok", "owner", base),            # same minute: not a reply
            (f"agent_{c % 2}", f"c{c}", f"p{c}", "ok", "owner", base + dt.timedelta(minutes=3 + c)),
        ]
    out.append(("agent_0", "late", "z", "z", "contact", T(2024, 1, 30, 9, 0)))  # advances the watermark
    return out


def stage(spark, parts):
    schema = "executive string, contact string, meta string, text string, role string, ts timestamp"
    df = spark.createDataFrame(rows(), schema)
    root = scratch_path(spark, "t-stream-in")
    # contiguous event-time ranges, staged oldest first (input arrives in time order)
    part = F.least(F.floor((F.dayofmonth("ts") - 1) * parts / 30), F.lit(parts - 1))
    for p in range(parts):
        df.where(part == p).coalesce(1).write.parquet(f"{root}/p{p:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(root)


def run(spark, stream, name):
    sink = scratch_path(spark, name)
    run_available(stream, sink, scratch_path(spark, name + "-ckpt"))
    return spark.read.parquet(sink)


def test_dedupe_one_vs_many_batches(spark):
    a = run(spark, dedupe_stream(stage(spark, 1), "ts", "1 hour"), "d1").select("contact", "meta", "text")
    b = run(spark, dedupe_stream(stage(spark, 5), "ts", "1 hour"), "d5").select("contact", "meta", "text")
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb and len(ra) == 6 * 3 + 1


def test_first_response_sessions(spark):
    out = run(spark, first_response_stream(stage(spark, 1), "ts", "2 hours", "1 hour"), "fr")
    got = {r["contact"]: r for r in out.collect()}
    assert "late" not in got                                 # still open when the input ends
    for c in range(6):
        r = got[f"c{c}"]
        assert r["has_inbound"] and r["has_outbound"]
        assert (r["out_ts"] - r["in_ts"]).total_seconds() == 60 * (3 + c)


def test_staged_halves_lose_no_row(spark):
    """The last day of a long month, a second month and rows without a time are all in one of the two parts."""
    from replylens.plans.streams import halves, run_staged
    schema = "executive string, contact string, meta string, text string, role string, ts timestamp"
    times = [T(2024, 1, d, 9, 0) for d in (1, 15, 30, 31)] + [T(2024, 2, d, 9, 0) for d in (1, 29)] + [None]
    df = spark.createDataFrame([("a", f"c{i}", f"m{i}", "whole text here", "contact", t) for i, t in enumerate(times)], schema)
    a, b = halves(df)
    assert sorted(r["contact"] for r in a.unionByName(b).collect()) == [f"c{i}" for i in range(7)]
    full = df.where("ts is not null")
    out = run_staged(spark, full.unionByName(full), lambda m: dedupe_stream(m, "ts", "1 hour"), "halves")
    assert sorted((r["contact"], r["text"]) for r in out.collect()) == [(f"c{i}", "whole text here") for i in range(6)]


def test_incremental_load_resumes_from_checkpoint(spark):
    """Two runs over one checkpoint: the second takes only the file that arrived
    since and merges it into the first one's snapshot."""
    import datetime as _dt

    from replylens.operators.leads import build_leads, coerce_history, prepare_new_leads
    from replylens.sinks.snapshots import current
    from replylens.streaming import consolidate_stream

    cols = ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante", "Hora Entrante",
            "Fecha Saliente", "Hora Saliente"]
    hist_cols = cols + ["Tiempo Respuesta (min)", "Score Tiempo Respuesta", "Segmento Horario Entrada"]
    schema = ", ".join(f"`{c}` string" for c in hist_cols)
    history = coerce_history(spark.createDataFrame(
        [("agent_a", "1", "SI", "NO", "2024-01-02", "10:00:00", None, None, None, None, None)], schema))
    batches = [
        [("agent_a", "1", "SI", "SI", "2024-01-01", "09:00", "2024-01-01", "09:04:00")],
        [("agent_b", "2", "SI", "SI", "hoy", "11:00:00", "2026-01-22", "12:00:00")],
        [("agent_b", "2", "SI", "NO", "2024-01-01", "08:00:00", None, None),
         ("agent_c", "3", "SI", "SI", "3/1/2024", "10:00:00.5", "2024-01-03", "10:00:30")],
    ]
    s = ", ".join(f"`{c}` string" for c in cols)
    inbox, snaps, ckpt = (scratch_path(spark, n) for n in ("t-inbox", "t-snaps", "t-ckpt"))
    as_of = _dt.date(2026, 1, 22)
    for i, b in enumerate(batches[:2]):
        spark.createDataFrame(b, s).coalesce(1).write.option("header", True).csv(f"{inbox}/b{i}")
    consolidate_stream(spark, inbox, snaps, history, as_of, ckpt, buckets=4)
    before = current(spark, snaps)
    spark.createDataFrame(batches[2], s).coalesce(1).write.option("header", True).csv(f"{inbox}/b2")
    final = consolidate_stream(spark, inbox, snaps, history, as_of, ckpt)   # restart: same checkpoint
    got = {r["lead_id"]: (r["executive"], r["score"]) for r in final.collect()}
    first, second = ([spark.createDataFrame(b, s) for b in part] for part in (batches[:2], batches[2:]))
    # What an earlier load has written is the history of the next one.
    base = build_leads(history, prepare_new_leads(first, as_of)).drop("response_seconds").withColumn("source_rank", F.lit(0))
    want = {r["lead_id"]: (r["executive"], r["score"]) for r in build_leads(base, prepare_new_leads(second, as_of)).collect()}
    assert got == want
    # A fresh checkpoint takes all files again: nothing is lost, nothing doubled, and the version grows.
    spark.createDataFrame([("agent_d", "9", "SI", "NO", "2024-01-05", "08:00:00", None, None)], s).write.option("header", True).csv(f"{inbox}/b3")
    again = consolidate_stream(spark, inbox, snaps, history, as_of, scratch_path(spark, "t-ckpt-fresh"))
    assert current(spark, snaps) > before
    now = {r["lead_id"]: (r["executive"], r["score"]) for r in again.collect()}
    assert set(now) == set(got) | {"9"} and now["1"] == got["1"]
    # history beats a new row of the same executive (export order); 10:00:00.5 -> 10:00:00, reply after 30 s
    assert got["1"] == ("agent_a", "not_answered") and got["3"] == ("agent_c", "automatic")


def lead_rows(spark, rows):
    from replylens.operators.leads import prepare_new_leads
    cols = ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante", "Hora Entrante", "Fecha Saliente", "Hora Saliente"]
    return prepare_new_leads(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols)).withColumn("source_file", F.lit("n.csv")), dt.date(2026, 1, 22))


def test_a_merge_rewrites_only_touched_buckets(spark):
    from replylens.operators.leads import build_leads
    from replylens.sinks.snapshots import bucket_of, manifest, read_buckets, write_buckets
    from replylens.streaming import merge_leads
    base = scratch_path(spark, "t-buckets")
    first = lead_rows(spark, [(f"agent_{i % 3}", str(i), "SI", "NO", "2024-01-02", "10:00:00", None, None) for i in range(200)])
    write_buckets(spark, base, build_leads(first, None), "lead_id", 8)
    old = manifest(spark, base)
    assert len(old) == 8
    new = lead_rows(spark, [("agent_0", "3", "SI", "SI", "2024-01-01", "09:00:00", "2024-01-01", "09:04:00"),
                            ("agent_z", None, "SI", "NO", "2024-01-01", "09:00:00", None, None)])
    version = merge_leads(spark, base, new)
    now = manifest(spark, base)
    touched = new.where("lead_id is not null").select(bucket_of(F.col("lead_id"), 8).alias("b")).first()["b"]
    assert [b for b in now if now[b] != old[b]] == [touched] and now[touched].startswith(version)
    import os
    from urllib.parse import urlparse
    files = [f for _, _, fs in os.walk(urlparse(version).path or version) for f in fs if f.startswith("part-")]
    assert len(files) == 1 + 2                               # the bucket, the manifest, the number of buckets
    got = {r["lead_id"]: (r["executive"], r["score"]) for r in read_buckets(spark, base).collect()}
    whole = build_leads(build_leads(first, None).drop("response_seconds").withColumn("source_rank", F.lit(0)), [new])
    assert got == {r["lead_id"]: (r["executive"], r["score"]) for r in whole.collect()} and len(got) == 200
    assert merge_leads(spark, base, new.where("lead_id is null")) is None and manifest(spark, base) == now


def test_pointer_is_replaced_and_days_rerun(spark):
    from replylens.operators.leads import coerce_history
    from replylens.sinks import write_snapshot
    from replylens.sinks.snapshots import current
    from replylens.sources.csv_scan import read_history
    base = scratch_path(spark, "t-published")
    leads = coerce_history(lead_rows(spark, [("a", "1", "SI", "NO", "2024-01-02", "10:00:00", None, None)]))
    one = write_snapshot(leads, base, dt.date(2024, 1, 3))
    assert current(spark, base) == one and [r["lead_id"] for r in read_history(spark, base).collect()] == ["1"]
    two = write_snapshot(leads.withColumn("lead_id", F.lit("2")), base, dt.date(2024, 1, 3))
    assert current(spark, base) == two != one and [r["lead_id"] for r in read_history(spark, base).collect()] == ["2"]
    assert [r["lead_id"] for r in read_history(spark, one).collect()] == ["1"]


def test_exports_keep_no_stale_folder_and_few_files(spark):
    import os
    from urllib.parse import urlparse
    from replylens.sinks import write_by_executive
    base = scratch_path(spark, "t-exports")
    leads = lead_rows(spark, [(n, str(i), "SI", "NO", "2024-01-02", "10:00:00", None, None) for i in range(300) for n in ("A", "B")]).repartition(7)
    write_by_executive(leads, base, "2024-01-03", rows_per_file=120)
    write_by_executive(leads, base, "2024-01-02", rows_per_file=120)
    write_by_executive(leads.where("executive = 'A'"), base, "2024-01-03", rows_per_file=120)
    root = urlparse(base).path or base
    found = {d: sum(f.endswith(".csv") for f in os.listdir(f"{root}/{d}")) for d in
             ("run_date=2024-01-03/executive=A", "run_date=2024-01-02/executive=A", "run_date=2024-01-02/executive=B")}
    assert os.listdir(f"{root}/run_date=2024-01-03").count("executive=B") == 0
    assert all(1 <= n <= 3 for n in found.values())
    assert spark.read.option("header", True).csv(base).count() == 900


def test_stream_and_open_sessions_are_all_sessions(spark):
    from replylens.streaming import open_sessions, session_counts
    schema = "executive string, contact string, meta string, text string, role string, ts timestamp"
    df = spark.createDataFrame([*rows(), ("agent_0", None, "z", "z", "contact", T(2024, 1, 30, 9, 5))], schema)
    root = scratch_path(spark, "t-open")
    df.write.parquet(root)
    make = lambda m: session_counts(m, "ts", "30 minutes", "1 hour")
    closed = run(spark, make(spark.readStream.schema(schema).parquet(root)), "open")
    still = open_sessions(df, make, ["contact"], "ts", "30 minutes", "1 hour")
    assert sorted(str(r["contact"]) for r in still.collect()) == ["None", "late"]
    assert sorted(map(str, closed.unionByName(still).collect())) == sorted(map(str, make(df).collect()))
    assert open_sessions(df.limit(0), make, ["contact"]).count() == 0


def test_open_sessions_keep_their_first_messages(spark):
    """A session that began long before the last watermark is whole."""
    from replylens.streaming import open_sessions
    schema = "executive string, contact string, meta string, text string, role string, ts timestamp"
    df = spark.createDataFrame([("a", "c", "m", "x", "contact" if i == 0 else "owner", T(2024, 1, 1, 9, 0) + dt.timedelta(minutes=100 * i))
                                for i in range(5)], schema)
    (r,) = open_sessions(df, lambda m: first_response_stream(m, "ts", "2 hours", "1 hour"), ["executive", "contact"], "ts", "2 hours", "1 hour").collect()
    assert r["has_inbound"] and (r["out_ts"] - r["in_ts"]).total_seconds() == 6000 and r["session_start"] == T(2024, 1, 1, 9, 0)


def test_raw_export_stream_rejects_what_does_not_parse(spark):
    import os
    from urllib.parse import urlparse
    from replylens.dims import dim_owner
    from replylens.streaming import parse_export_stream, read_export_stream
    root = urlparse(scratch_path(spark, "t-raw")).path or scratch_path(spark, "t-raw")
    os.makedirs(root)
    with open(f"{root}/Ana.csv", "w", encoding="utf-8") as f:
        f.write('contact,meta,text\nc1,"[9:00, 3/1/2024] c1: ","hola\ntwo"\nc1,"[9:05, 3/1/2024] You: ",ok\nc1,no date,x\nc1,"[9:99, 3/1/2024] c1:",y\nonly one cell\n')
    good, rejected = parse_export_stream(read_export_stream(spark, root), dim_owner(spark))
    got = run(spark, good.drop("ts"), "raw-good").collect()
    assert sorted((r["executive"], r["role"], r["text"]) for r in got) == [("Ana", "contact", "hola\ntwo"), ("Ana", "owner", "ok")]
    bad = run(spark, rejected, "raw-bad").collect()
    assert sorted((r["contact"], r["reason"]) for r in bad) == [("c1", "meta"), ("c1", "meta"), ("only one cell", "cells")]


def test_a_session_query_parses_its_messages_once(spark, tmpdir_fresh, monkeypatch):
    from replylens.plans import streams
    times = [T(2024, 1, 2, 9, 0) + dt.timedelta(minutes=20 * i + 400 * (i // 3)) for i in range(9)]
    events = [(i, t, 7, ("view", "purchase", "error")[i % 3], 1.0, "p") for i, t in enumerate(times)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(
        f"{tmpdir_fresh}/events.parquet")
    seen, parse = spark.sparkContext.accumulator(0), streams.parse_chat_export

    def counted(x):
        seen.add(1)
        return x
    monkeypatch.setattr(streams, "parse_chat_export", lambda raw: parse(raw).withColumn(
        "contact", F.udf(counted, "string").asNondeterministic()("contact")))
    got = sorted((r["contact"], r["session_start"], r["session_end"], r["messages"]) for r in streams.q_stream_sessions(spark, tmpdir_fresh).collect())
    assert got == [("contact 7", times[i], times[i + 2] + dt.timedelta(minutes=30), 3) for i in (0, 3, 6)]
    assert seen.value == len(events)
