"""DuckDB oracles for lead, schedule and report queries (plain SQL, row_number brute force)."""

from __future__ import annotations

from .oracle import ORACLE, oracle

AS_OF = "DATE '2026-01-22'"

FACTS = """
facts AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS lead_id,
         'agent_' || chr(CAST(97 + o_orderkey % 5 AS INTEGER)) AS executive,
         CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey * 7919 % 86400 AS BIGINT)) AS in_ts,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey * 7919 % 86400 AS BIGINT))
                   + to_seconds(CAST(CASE o_orderkey % 8 WHEN 0 THEN 20 WHEN 1 THEN 200 WHEN 2 THEN 800
                        WHEN 3 THEN 3000 WHEN 4 THEN 40000 WHEN 5 THEN 500000 WHEN 6 THEN -600
                        ELSE o_orderkey * 37 % 200000 END AS BIGINT)) END AS out_ts,
         CAST(o_orderkey % 2 AS INTEGER) AS source_rank,
         o_orderkey // 2 AS s
  FROM orders)"""

# History rows after coercion (ISO cells; '30:00:00' is not a valid time of day).
HISTORY = """
history AS (
  SELECT executive, lead_id, true AS has_inbound, out_ts IS NOT NULL AS has_outbound,
         CAST(in_ts AS DATE) AS in_date, strftime(in_ts, '%H:%M:%S') AS in_time,
         CAST(out_ts AS DATE) AS out_date, strftime(out_ts, '%H:%M:%S') AS out_time,
         CASE WHEN s % 5 = 1 THEN '00:00:30' END AS response_time,
         CASE WHEN s % 5 = 1 THEN 'excellent' WHEN s % 5 = 3 THEN 'slow' END AS score,
         CASE WHEN s % 5 = 2 THEN 'evening' END AS entry_segment,
         0 AS source_rank, 'history' AS source_file
  FROM facts WHERE k % 2 = 0)"""

# New rows: dates resolved from their text style, times as written (raw) and normalised.
NEW = f"""
new AS (
  SELECT executive, lead_id, true AS has_inbound,
         CASE WHEN k % 3 = 2 THEN out_ts IS NOT NULL ELSE out_ts IS NOT NULL END AS has_outbound,
         CASE s % 6 WHEN 3 THEN {AS_OF} WHEN 4 THEN {AS_OF} - 1 WHEN 5 THEN NULL
              ELSE CAST(in_ts AS DATE) END AS in_date,
         CASE (k // 12) % 4 WHEN 0 THEN strftime(in_ts, '%H:%M:%S') WHEN 1 THEN strftime(in_ts, '%H:%M')
              WHEN 2 THEN strftime(in_ts, '%H:%M:%S.%f') ELSE '' END AS in_time_raw,
         CASE (k // 12) % 4 WHEN 0 THEN strftime(in_ts, '%H:%M:%S') WHEN 1 THEN strftime(in_ts, '%H:%M') || ':00'
              WHEN 2 THEN strftime(in_ts, '%H:%M:%S') END AS in_time,
         CASE WHEN k % 3 = 2 THEN NULL ELSE CAST(out_ts AS DATE) END AS out_date,
         CASE WHEN k % 3 = 2 THEN NULL ELSE strftime(out_ts, '%H:%M:%S') END AS out_time,
         CAST(NULL AS VARCHAR) AS response_time, CAST(NULL AS VARCHAR) AS score,
         CAST(NULL AS VARCHAR) AS entry_segment, 1 AS source_rank,
         'new_' || CAST(k % 3 AS VARCHAR) || '.csv' AS source_file, k, s, in_ts
  FROM facts WHERE k % 2 = 1)"""

COLS = ("executive, lead_id, has_inbound, has_outbound, in_date, in_time, out_date, out_time, "
        "response_time, score, entry_segment, source_rank, source_file")

MERGED = f"""
merged AS (
  SELECT {COLS} FROM history
  UNION ALL
  SELECT executive, lead_id, has_inbound, has_outbound, in_date, in_time, out_date, out_time,
         response_time, score, entry_segment, source_rank, source_file FROM new)"""

DEDUPED = f"""
deduped AS (
  SELECT {COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY
      executive IS NULL, executive, in_date IS NULL, source_rank, in_date, in_time IS NULL, in_time,
      out_date IS NULL, out_date, out_time IS NULL, out_time, source_file IS NULL, source_file,
      has_inbound NULLS FIRST, has_outbound NULLS FIRST, response_time NULLS FIRST, score NULLS FIRST,
      entry_segment NULLS FIRST) AS rn
    FROM merged WHERE lead_id IS NOT NULL) WHERE rn = 1)"""


def bucket(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN abs({x}) < 60 THEN 'automatic' WHEN {x} <= 300 THEN 'excellent' "
            f"WHEN {x} <= 900 THEN 'good' WHEN {x} <= 3600 THEN 'regular' WHEN {x} <= 86400 THEN 'slow' "
            f"ELSE 'very_slow' END")


def hms_secs(x: str) -> str:
    return (f"CASE WHEN len(string_split({x}, ':')) = 3 THEN "
            f"TRY_CAST(string_split({x}, ':')[1] AS BIGINT) * 3600 + TRY_CAST(string_split({x}, ':')[2] AS BIGINT) * 60 "
            f"+ TRY_CAST(string_split({x}, ':')[3] AS BIGINT) END")


def segment(x: str) -> str:
    h = f"CAST(regexp_extract({x}, '^(2[0-3]|[01]?\\d):([0-5]?\\d):([0-5]?\\d)$', 1) AS INTEGER)"
    return (f"CASE WHEN NOT regexp_full_match(coalesce({x}, ''), '(2[0-3]|[01]?\\d):([0-5]?\\d):([0-5]?\\d)') THEN NULL "
            f"WHEN {h} < 6 THEN 'early_morning' WHEN {h} < 9 THEN 'morning_off' WHEN {h} < 13 THEN 'morning_work' "
            f"WHEN {h} < 18 THEN 'afternoon' WHEN {h} < 23 THEN 'evening' ELSE 'late_evening' END")


def scored(src: str) -> str:
    """Response time, score and segment over a lead CTE ``src`` (canonical columns)."""
    return f"""
r1 AS (
  SELECT {src}.*,
         try_strptime(CAST(in_date AS VARCHAR) || ' ' || in_time, '%Y-%m-%d %H:%M:%S') AS in2,
         try_strptime(CAST(out_date AS VARCHAR) || ' ' || out_time, '%Y-%m-%d %H:%M:%S') AS out2
  FROM {src}),
r2 AS (
  SELECT r1.*, (response_time IS NULL AND out_date IS NOT NULL AND out_time IS NOT NULL
                AND in2 IS NOT NULL AND out2 IS NOT NULL AND out2 >= in2) AS filled,
         date_diff('second', in2, out2) AS d
  FROM r1),
r3 AS (
  SELECT r2.* REPLACE (CASE WHEN filled THEN printf('%02d:%02d:%02d', d // 3600, (d % 3600) // 60, d % 60)
                            ELSE response_time END AS response_time)
  FROM r2),
r4 AS (
  SELECT r3.*, {hms_secs('response_time')} AS secs FROM r3),
r5 AS (
  SELECT r4.* REPLACE (coalesce(
           CASE WHEN in2 IS NOT NULL AND out2 IS NOT NULL AND out2 >= in2 AND secs IS NOT NULL
                     AND (filled OR score IS NULL) THEN {bucket('secs')} ELSE score END,
           CASE WHEN in2 IS NOT NULL AND out2 IS NOT NULL AND out2 < in2 THEN 'outbound'
                WHEN (out_date IS NULL OR out_time IS NULL) AND in_date IS NOT NULL AND in_time IS NOT NULL
                THEN 'not_answered' END) AS score,
         coalesce(entry_segment, {segment('in_time')}, 'not_registered') AS entry_segment)
  FROM r4)"""


SCORED_COLS = COLS + ", secs AS response_seconds"
SCORED = f"WITH {FACTS},{HISTORY},{NEW},{MERGED},{DEDUPED},{scored('deduped')}"
TYPED = f"""
typed AS (
  SELECT executive, lead_id, true AS has_inbound, out_ts IS NOT NULL AS has_outbound,
         CAST(in_ts AS DATE) AS in_date, strftime(in_ts, '%H:%M:%S') AS in_time,
         CAST(out_ts AS DATE) AS out_date, strftime(out_ts, '%H:%M:%S') AS out_time,
         CAST(NULL AS VARCHAR) AS response_time, CAST(NULL AS VARCHAR) AS score,
         CAST(NULL AS VARCHAR) AS entry_segment, source_rank, 'order_' || CAST(k AS VARCHAR) AS source_file
  FROM facts)"""

oracle("coerce_history", f"WITH {FACTS},{HISTORY} SELECT {COLS} FROM history")

oracle("align_schema", f"""
WITH {FACTS},{NEW}
SELECT executive, lead_id, has_inbound, has_outbound, in_date, in_time_raw AS in_time, out_date, out_time,
       response_time, score, entry_segment, source_rank, source_file FROM new""")

oracle("consolidate_history", f"""
WITH {FACTS},{HISTORY},{NEW},
m2 AS (
  SELECT {COLS} FROM history
  UNION ALL
  SELECT executive, lead_id, has_inbound, has_outbound, in_date, in_time_raw, out_date, out_time,
         response_time, score, entry_segment, source_rank, source_file FROM new)
SELECT * FROM m2""")

oracle("normalize_dates", f"""
WITH {FACTS}
SELECT lead_id,
       CASE s % 6 WHEN 0 THEN strftime(in_ts, '%Y-%m-%d') WHEN 1 THEN strftime(in_ts, '%-d/%-m/%Y')
            WHEN 2 THEN strftime(in_ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN 'hoy' WHEN 4 THEN ' Ayer ' ELSE 'nan' END AS raw,
       CASE s % 6 WHEN 3 THEN {AS_OF} WHEN 4 THEN {AS_OF} - 1 WHEN 5 THEN NULL ELSE CAST(in_ts AS DATE) END AS in_date
FROM facts WHERE k % 2 = 1""")

oracle("normalize_dates_strict", f"""
WITH {FACTS}
SELECT lead_id,
       CASE s % 6 WHEN 0 THEN strftime(in_ts, '%Y-%m-%d') WHEN 1 THEN strftime(in_ts, '%-d/%-m/%Y')
            WHEN 2 THEN strftime(in_ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN 'hoy' WHEN 4 THEN ' Ayer ' ELSE 'nan' END AS raw,
       CASE WHEN s % 6 IN (0, 2) THEN CAST(in_ts AS DATE)
            WHEN s % 6 = 1 AND day(in_ts) >= 10 AND month(in_ts) >= 10 THEN CAST(in_ts AS DATE) END AS in_date
FROM facts WHERE k % 2 = 1""")

oracle("normalize_times", f"""
WITH {FACTS},{NEW}
SELECT lead_id, in_time_raw AS raw, in_time FROM new""")

oracle("null_tokens", f"""
WITH {FACTS}
SELECT lead_id AS id_lead,
       CASE s % 6 WHEN 0 THEN strftime(in_ts, '%Y-%m-%d') WHEN 1 THEN strftime(in_ts, '%-d/%-m/%Y')
            WHEN 2 THEN strftime(in_ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN 'hoy' WHEN 4 THEN ' Ayer ' END AS fecha_entrante,
       CASE (k // 12) % 4 WHEN 0 THEN strftime(in_ts, '%H:%M:%S') WHEN 1 THEN strftime(in_ts, '%H:%M')
            WHEN 2 THEN strftime(in_ts, '%H:%M:%S.%f') END AS hora_entrante,
       strftime(out_ts, '%Y-%m-%d') AS fecha_saliente, strftime(out_ts, '%H:%M:%S') AS hora_saliente
FROM facts WHERE k % 2 = 1""")

oracle("dedupe_leads", f"WITH {FACTS},{HISTORY},{NEW},{MERGED},{DEDUPED} SELECT * FROM deduped")

oracle("response_time", f"""
WITH {FACTS},{TYPED},{scored('typed')}
SELECT source_file, lead_id, in_date, in_time, out_date, out_time, response_time FROM r5""")

oracle("score", f"""
WITH {FACTS},{TYPED},{scored('typed')}
SELECT source_file, lead_id, response_time, score FROM r5""")

oracle("entry_segment", f"""
WITH {FACTS},{TYPED},{scored('typed')}
SELECT source_file, lead_id, in_time, entry_segment FROM r5""")

oracle("scored_leads", f"{SCORED} SELECT {SCORED_COLS} FROM r5")

oracle("aliased_leads", f"{SCORED} SELECT {SCORED_COLS} FROM r5")

oracle("map_executive", f"""
WITH {FACTS}
SELECT 'order_' || CAST(k AS VARCHAR) AS source_file,
       CASE WHEN k % 10 = 0 AND executive = 'agent_a' THEN 'agent_a'
            WHEN k % 10 = 0 THEN upper(executive) ELSE executive END AS executive
FROM facts""")

_PROFILE_RAW = """
raw AS (
  SELECT CASE s % 6 WHEN 0 THEN strftime(in_ts, '%Y-%m-%d') WHEN 1 THEN strftime(in_ts, '%-d/%-m/%Y')
              WHEN 2 THEN strftime(in_ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN 'hoy' WHEN 4 THEN ' Ayer ' ELSE 'nan' END AS v
  FROM facts WHERE k % 2 = 1),
lab AS (
  SELECT trim(v) AS v, CASE
    WHEN regexp_full_match(trim(v), '\\d{4}-\\d{2}-\\d{2}') THEN 'YYYY-MM-DD'
    WHEN regexp_full_match(trim(v), '\\d{2}-\\d{2}-\\d{4}') THEN 'DD-MM-YYYY'
    WHEN regexp_full_match(trim(v), '\\d{2}/\\d{2}/\\d{4}') THEN 'DD/MM/YYYY'
    WHEN regexp_full_match(trim(v), '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}') THEN 'YYYY-MM-DD HH:MM:SS'
    WHEN regexp_full_match(trim(v), '\\d{2}/\\d{2}/\\d{4} \\d{2}:\\d{2}:\\d{2}') THEN 'DD/MM/YYYY HH:MM:SS'
    ELSE 'unmatched' END AS pattern
  FROM raw)"""

oracle("date_format_profile", f"""
WITH {FACTS},{_PROFILE_RAW}
SELECT pattern, count(*) AS n FROM lab GROUP BY ROLLUP (pattern)""")

oracle("date_format_odd_values", f"""
WITH {FACTS},{_PROFILE_RAW}
SELECT DISTINCT v AS value FROM lab WHERE pattern = 'unmatched' ORDER BY value LIMIT 20""")

oracle("date_bounds", f"{SCORED} SELECT max(in_date) AS max_in_date, max(out_date) AS max_out_date FROM r5")

oracle("latest_leads", f"""{SCORED}
SELECT {SCORED_COLS} FROM r5 ORDER BY in_date DESC NULLS LAST, lead_id, executive LIMIT 40""")

oracle("latest_replies", f"""{SCORED}
SELECT {SCORED_COLS} FROM r5 ORDER BY out_date DESC NULLS LAST, lead_id, executive LIMIT 40""")

oracle("lead_lookup", f"{SCORED} SELECT {SCORED_COLS} FROM r5 WHERE lead_id = '10'")

oracle("executive_date_slice", f"""{SCORED}
SELECT {SCORED_COLS} FROM r5 WHERE executive = 'agent_b' AND in_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'""")

oracle("date_slice", f"""{SCORED}
SELECT {SCORED_COLS} FROM r5 WHERE in_date >= DATE '1999-01-01' AND in_date <= DATE '1999-01-31'""")

oracle("distinct_executives", f"{SCORED} SELECT DISTINCT executive FROM r5")

oracle("kpi_score_rollup", f"""{SCORED}
SELECT executive, score, count(*) AS leads, CAST(grouping(executive, score) AS BIGINT) AS level
FROM r5 GROUP BY ROLLUP (executive, score)""")

oracle("kpi_response_stats", f"""{SCORED}
SELECT executive, entry_segment, count(*) AS leads,
       round(avg(CASE WHEN secs IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS answered_share,
       round(avg(CAST(secs AS DOUBLE)), 3) AS avg_seconds,
       round(quantile_cont(CAST(secs AS DOUBLE), 0.5), 3) AS median_seconds,
       round(quantile_cont(CAST(secs AS DOUBLE), 0.9), 3) AS p90_seconds
FROM r5 GROUP BY executive, entry_segment""")

# ------------------------------------------------------------------ schedule
SHEET = """
weeks AS (
  SELECT DISTINCT CAST(date_trunc('week', in_ts) AS DATE) AS ws FROM facts WHERE in_ts IS NOT NULL),
wk AS (SELECT ws, ws + 5 AS we, date_diff('day', DATE '1970-01-05', ws) // 7 AS wk FROM weeks),
texts AS (SELECT ['Mañana', 'manana', 'TARDE', 'turno tarde', 'libre', 'Tarde/Mañana'] AS t),
sheet AS (
  SELECT 'week_grid' AS sheet, wk * 10 AS row_no,
         CASE WHEN wk % 29 = 3 THEN strftime(we, '%Y-%m-%d') ELSE strftime(ws, '%Y-%m-%d') END AS c0,
         CASE WHEN wk % 29 = 3 THEN strftime(ws, '%-d/%-m/%Y') ELSE strftime(we, '%-d/%-m/%Y') END AS c1,
         CAST(NULL AS VARCHAR) AS c2
  FROM wk
  UNION ALL
  SELECT 'week_grid', wk * 10 + i + 1, ['AGENT_A', 'agent_b', ' ag.c ', 'agent_d', 'agent_e'][i + 1], NULL,
         t[((wk + i) % 6) + 1]
  FROM wk, texts, range(5) r(i)
  UNION ALL
  SELECT 'week_grid', wk * 10 + 6, CASE WHEN wk % 3 = 0 THEN 'agent_b' END, NULL, 'Tarde' FROM wk
  UNION ALL
  SELECT 'week_grid', wk * 10 + 7, CASE WHEN wk % 4 = 0 THEN 'agent_d' END, NULL, t[((wk + 3) % 6) + 1]
  FROM wk, texts
  UNION ALL
  SELECT 'week_grid', -1, 'agent_a', NULL, 'Mañana')"""

CLASSIFY = ("CASE WHEN contains(strip_accents(lower(trim({x}))), 'tarde') THEN 'tarde' "
            "WHEN contains(strip_accents(lower(trim({x}))), 'manana') OR contains(lower(trim({x})), 'mañana') "
            "THEN 'mañana' END")


def sheet_date(x: str) -> str:
    return (f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%d/%m/%Y')) AS DATE)")


RULES_ALL = """
rules(p, ex, d, wf, wt, sh, a, s, e) AS (VALUES
  (10, NULL, NULL, 6, 6, NULL, 'off', NULL, NULL),
  (15, NULL, DATE '1996-05-02', NULL, NULL, NULL, 'off', NULL, NULL),
  (22, 'agent_e', DATE '1998-08-18', NULL, NULL, NULL, 'off', NULL, NULL),
  (23, 'agent_e', DATE '1998-08-20', NULL, NULL, NULL, 'hours', '10:20', '12:45'),
  (27, NULL, DATE '1997-02-07', NULL, NULL, 'mañana', 'hours', '06:40', '11:05'),
  (33, 'agent_a', NULL, 2, 3, NULL, 'hours', '07:15', '11:45'),
  (34, 'agent_a', NULL, NULL, NULL, 'tarde', 'default', NULL, NULL),
  (45, NULL, NULL, 4, 4, 'tarde', 'hours', '15:35', '20:10'),
  (46, 'agent_d', NULL, 0, 1, 'mañana', 'hours', '11:25', '19:50')),
cutoffs(cd, cut) AS (VALUES (DATE '1999-09-07', '16:20'), (DATE '1996-11-22', '11:10'))"""

RULES_SUNDAY = """
rules(p, ex, d, wf, wt, sh, a, s, e) AS (VALUES
  (10, NULL, NULL, 6, 6, NULL, 'off', NULL, NULL),
  (99, 'nobody', NULL, NULL, NULL, NULL, 'off', NULL, NULL)),
cutoffs(cd, cut) AS (SELECT DATE '1900-01-01', '00:00' WHERE false)"""


def schedule_sql(rules: str) -> str:
    return f"""
{SHEET},
{rules},
shifts(shift, ds, de) AS (VALUES ('mañana', '09:00', '18:00'), ('manana', '09:00', '18:00'), ('tarde', '14:00', '22:00')),
aliases(raw, ex) AS (VALUES ('AGENT_A', 'agent_a'), ('Agent B', 'agent_b'), ('ag.c', 'agent_c')),
s1 AS (
  SELECT sheet.*, {sheet_date('c0')} AS d0, {sheet_date('c1')} AS d1,
         ({sheet_date('c0')} IS NOT NULL AND {sheet_date('c1')} IS NOT NULL AND (c2 IS NULL OR trim(c2) = '')) AS hdr
  FROM sheet),
s2 AS (
  SELECT s1.*,
    last_value(CASE WHEN hdr THEN d0 END IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS week_start,
    last_value(CASE WHEN hdr THEN d1 END IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS week_end
  FROM s1),
ops AS (
  SELECT sheet, row_no, trim(c0) AS op, {CLASSIFY.format(x='c2')} AS shift, week_start, week_end
  FROM s2 WHERE NOT hdr AND week_start IS NOT NULL AND week_end IS NOT NULL),
ops2 AS (
  SELECT ops.*, coalesce(aliases.ex, op) AS executive FROM ops LEFT JOIN aliases ON ops.op = aliases.raw
  WHERE op IS NOT NULL AND op <> '' AND shift IS NOT NULL AND week_start <= week_end),
days AS (
  SELECT sheet, row_no, executive, shift, CAST(unnest(generate_series(week_start, week_end, INTERVAL 1 DAY)) AS DATE) AS fecha
  FROM ops2),
days2 AS (SELECT days.*, isodow(fecha) - 1 AS weekday FROM days),
matched AS (
  SELECT days2.*, rules.p, rules.a, rules.s, rules.e,
         row_number() OVER (PARTITION BY sheet, row_no, fecha ORDER BY rules.p NULLS LAST, rules.a NULLS FIRST,
                            rules.s NULLS FIRST, rules.e NULLS FIRST) AS rn
  FROM days2 LEFT JOIN rules ON (rules.ex IS NULL OR lower(rules.ex) = lower(days2.executive))
     AND (rules.d IS NULL OR rules.d = days2.fecha)
     AND (rules.wf IS NULL OR days2.weekday >= rules.wf) AND (rules.wt IS NULL OR days2.weekday <= rules.wt)
     AND (rules.sh IS NULL OR rules.sh = days2.shift)),
won AS (
  SELECT matched.*, coalesce(a, 'default') AS action FROM matched WHERE rn = 1),
hours AS (
  SELECT won.*, CASE WHEN action = 'hours' THEN won.s ELSE shifts.ds END AS hora_inicio,
         CASE WHEN action = 'hours' THEN won.e ELSE shifts.de END AS hora_fin
  FROM won LEFT JOIN shifts ON won.shift = shifts.shift WHERE action <> 'off'),
ts AS (
  SELECT hours.*, strptime(CAST(fecha AS VARCHAR) || ' ' || hora_inicio || ':00', '%Y-%m-%d %H:%M:%S') AS inicio_dt,
         strptime(CAST(fecha AS VARCHAR) || ' ' || hora_fin || ':00', '%Y-%m-%d %H:%M:%S') AS fin_dt0,
         cutoffs.cut, strptime(CAST(fecha AS VARCHAR) || ' ' || cutoffs.cut || ':00', '%Y-%m-%d %H:%M:%S') AS cut_ts
  FROM hours LEFT JOIN cutoffs ON hours.fecha = cutoffs.cd
  WHERE hora_inicio IS NOT NULL AND hora_fin IS NOT NULL),
clip AS (
  SELECT sheet, row_no, fecha, executive, shift, hora_inicio,
         CASE WHEN cut IS NOT NULL AND fin_dt0 > cut_ts THEN cut ELSE hora_fin END AS hora_fin,
         inicio_dt, CASE WHEN cut IS NOT NULL AND fin_dt0 > cut_ts THEN cut_ts ELSE fin_dt0 END AS fin_dt
  FROM ts WHERE cut IS NULL OR inicio_dt < cut_ts),
sched AS (
  SELECT fecha, executive, shift AS turno, hora_inicio, hora_fin, inicio_dt, fin_dt FROM (
    SELECT clip.*, row_number() OVER (PARTITION BY fecha, executive, inicio_dt, fin_dt
                                      ORDER BY sheet, row_no, shift, hora_inicio, hora_fin) AS rn
    FROM clip) WHERE rn = 1),
win AS (
  SELECT executive, fecha, min(inicio_dt) AS inicio_dt, max(fin_dt) AS fin_dt FROM sched GROUP BY executive, fecha)"""


oracle("classify_shift", f"""
WITH {FACTS},{SHEET}
SELECT row_no, c2, {CLASSIFY.format(x='c2')} AS shift FROM sheet WHERE c2 IS NOT NULL""")

oracle("schedule_expand", f"WITH {FACTS},{schedule_sql(RULES_SUNDAY)} SELECT * FROM sched")
oracle("schedule_rules", f"WITH {FACTS},{schedule_sql(RULES_ALL)} SELECT * FROM sched")
oracle("shift_windows", f"WITH {FACTS},{schedule_sql(RULES_ALL)} SELECT * FROM win")

_LEADS_AND_WINDOWS = (f"WITH {FACTS},{HISTORY},{NEW},{MERGED},{DEDUPED},{scored('deduped')},"
                      f"{schedule_sql(RULES_ALL)}")

oracle("shift_join", f"""{_LEADS_AND_WINDOWS}
SELECT r5.executive, r5.lead_id, r5.in_date, r5.in_time, win.inicio_dt, win.fin_dt
FROM r5 LEFT JOIN win ON r5.executive = win.executive AND r5.in_date = win.fecha""")

_IN_WIN = """EXISTS (SELECT 1 FROM win WHERE win.executive = r5.executive AND win.fecha = r5.in_date
              AND r5.in2 >= win.inicio_dt AND r5.in2 <= win.fin_dt)"""

oracle("in_shift_leads", f"{_LEADS_AND_WINDOWS} SELECT {SCORED_COLS} FROM r5 WHERE {_IN_WIN}")
oracle("off_shift_leads", f"{_LEADS_AND_WINDOWS} SELECT {SCORED_COLS} FROM r5 WHERE NOT {_IN_WIN}")

oracle("scan_mixed_headers", f"""
WITH {FACTS},{NEW}
SELECT executive, lead_id, has_inbound, has_outbound, in_date, nullif(in_time_raw, '') AS in_time, out_date,
       out_time, response_time, score, entry_segment, source_rank, source_file FROM new""")

oracle("stream_consolidate", f"{SCORED} SELECT {SCORED_COLS} FROM r5")

# Scored leads written as a snapshot and read back as history: response times of
# 24 h or more are not valid history cells; the source becomes the history.
oracle("lead_csv_roundtrip", f"""{SCORED}
SELECT executive, lead_id, has_inbound, has_outbound, in_date, in_time, out_date, out_time,
       CASE WHEN regexp_full_match(coalesce(response_time, ''), '(2[0-3]|[01]?\\d):([0-5]?\\d):([0-5]?\\d)')
            THEN response_time END AS response_time,
       score, entry_segment, 0 AS source_rank, 'history' AS source_file
FROM r5""")

oracle("slice_csv_roundtrip", ORACLE["lead_csv_roundtrip"]
       + " WHERE executive = 'agent_b' AND in_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")

oracle("history_own_columns", f"""WITH {FACTS},{HISTORY}
SELECT executive, lead_id, in_date, in_time, CASE WHEN CAST(lead_id AS BIGINT) % 7 = 0 THEN 'VIP manual' ELSE score END AS score,
       entry_segment, 'nota "' || lead_id || '",' || chr(10) || 'fin' AS "Notas" FROM history""")
