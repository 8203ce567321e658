"""One key holding a third of all rows: results equal a plain-Python brute force,
and the hot key takes the broadcast route instead of one shuffle task."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from replylens.dims import dim_inbox, dim_owner
from replylens.operators.capture import apply_capture_policy
from replylens.operators.chats import chat_first_response
from replylens.operators.inbox import inbox_first_response
from replylens.operators.joins import join_per_key
from replylens.operators.joins import HOT_KEY_CONF
from replylens.operators.leads import dedupe_leads

SYS = "Asignado a X por Automation System"
BASE = dt.datetime(2024, 1, 1, 12, 0)


@pytest.fixture()
def low_hot_threshold(spark):
    spark.conf.set(HOT_KEY_CONF, "500")
    yield
    spark.conf.unset(HOT_KEY_CONF)


def inbox_rows(seed=3):
    rnd = random.Random(seed)
    rows, mid = [], 0
    for conv in range(60):
        n = 3000 if conv == 0 else rnd.randint(1, 40)      # conversation 0 ~ a third of the rows
        for i in range(n):
            mid += 1
            sender = "User" if rnd.random() < 0.45 else "Contact"
            content = SYS if rnd.random() < 0.1 else "msg"
            t = BASE + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
            rows.append((mid, conv, conv % 6, sender, t, f"c{conv}" + (" (GROUP)" if conv == 7 else ""), content))
    return rows


def inbox_brute(rows):
    by = {}
    for r in rows:
        if r[2] <= 4:
            by.setdefault(r[1], []).append(r)
    out = set()
    for conv, g in by.items():
        g.sort(key=lambda r: (r[4], r[0], r[3], r[6]))
        real = [r for r in g if not (("Asignado a" in r[6]) and ("por Automation System" in r[6]))]
        if not real or real[0][5].strip().endswith("(GROUP)"):
            continue
        first = real[0]
        replies = [r for i, r in enumerate(g) if r[3] == "User" and i > 0]
        fin = first[4] - dt.timedelta(hours=5)
        rep = replies[0][4] - dt.timedelta(hours=5) if replies else None
        out.add((f"agent_{'abcde'[first[2]]}", str(conv), first[3] == "Contact", rep is not None, fin.date(),
                 fin.strftime("%H:%M:%S"), rep.date() if rep else None, rep.strftime("%H:%M:%S") if rep else None))
    return out


def test_inbox_hot_conversation(spark, low_hot_threshold):
    rows = inbox_rows()
    df = spark.createDataFrame(rows, "message_id bigint, conversation_id bigint, inbox_id bigint, sender_type string, "
                                     "sent_at timestamp_ntz, contact_name string, content string").repartition(8)
    out = inbox_first_response(df, dim_inbox(spark))
    got = {tuple(r) for r in out.collect()}
    assert got == inbox_brute(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan                           # two rows of a kind a task, whatever the conversation


@pytest.mark.parametrize("max_keys", [100, 2])
def test_hot_keys_meet_their_partners_by_broadcast_or_salt(spark, max_keys):
    big = spark.createDataFrame([(i % 5 if i % 2 else None if i % 14 == 0 else 0, i) for i in range(3000)], "k int, v int")
    per = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c"), (9, "d")], "k int, name string")
    for how in ("inner", "left"):
        got = join_per_key(big, per, ["k"], how, hot_rows=100, max_keys=max_keys)
        assert sorted(map(str, got.select("k", "v", "name").collect())) == sorted(map(str, big.join(per, "k", how).select("k", "v", "name").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin [k" in plan) == (max_keys == 100) or "_salt" in plan


def test_chat_hot_contact(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(40):
        n = 2000 if c == 0 else rnd.randint(1, 30)
        for _ in range(n):
            t = BASE + dt.timedelta(minutes=rnd.randint(0, 600))
            who = rnd.choice(["You", f"k{c}", None])
            rows.append(("agent_a", f"k{c}", t, who))
    df = spark.createDataFrame(rows, "executive string, contact string, dt timestamp_ntz, author string")
    got = {(r["lead_id"], r["has_inbound"], r["has_outbound"], r["in_time"], r["out_time"])
           for r in chat_first_response(df, dim_owner(spark)).collect()}
    want = set()
    for c in range(40):
        g = [r for r in rows if r[1] == f"k{c}"]
        first = min(r[2] for r in g)
        inbound = any(r[2] == first and r[3] not in (None, "You") for r in g)
        owner_after = [r[2] for r in g if r[3] == "You" and r[2] > first]
        if inbound:
            reply = min(owner_after) if owner_after else None
            want.add((f"k{c}", True, reply is not None, first.strftime("%H:%M:%S"),
                      reply.strftime("%H:%M:%S") if reply else None))
        else:
            want.add((f"k{c}", False, True, None, first.strftime("%H:%M:%S")))
    assert got == want


def test_dedupe_hot_lead(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        lead = "hot" if i % 3 == 0 else f"l{rnd.randint(0, 800)}"
        rows.append((rnd.choice(["agent_a", "agent_b"]), lead, dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 30)),
                     f"{rnd.randint(0, 23):02d}:00:00", rnd.randint(0, 1), f"f{i}"))
    df = spark.createDataFrame(rows, "executive string, lead_id string, in_date date, in_time string, "
                                     "source_rank int, source_file string")
    df = df.withColumn("out_date", F.lit(None).cast("date")).withColumn("out_time", F.lit(None).cast("string"))
    got = {r["lead_id"]: r["source_file"] for r in dedupe_leads(df).collect()}
    want = {}
    for lead in {r[1] for r in rows}:
        g = [r for r in rows if r[1] == lead]
        g.sort(key=lambda r: (r[0], r[4], r[2], r[3], r[5]))
        want[lead] = g[0][5]
    assert got == want


def test_capture_policy_hot_chat(spark, low_hot_threshold):
    msgs = spark.createDataFrame([("hot" if i % 3 == 0 else f"c{i % 50}", i) for i in range(6000)],
                                 "contact string, i int")
    log = spark.createDataFrame([("hot", "ok", 0)] + [(f"c{j}", "ok" if j % 2 else "timed_out", 0) for j in range(50)],
                                "contact string, status string, messages bigint")
    got = apply_capture_policy(msgs, log, keep_partial=False)
    want = sum(1 for i in range(6000) if i % 3 == 0 or (i % 50) % 2 == 1)
    assert got.count() == want
    assert got.where(F.col("contact") == "hot").count() == 2000
