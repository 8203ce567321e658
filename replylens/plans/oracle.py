"""DuckDB oracle SQL for the registered queries.

Each statement recomputes a query's answer from the raw test tables with
plain SQL (row_number / window brute force where the Spark plan uses
aggregates and anchor joins), so the two sides share only the adapter rules.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    if name in ORACLE:
        raise ValueError(f"duplicate oracle {name}")
    ORACLE[name] = sql.strip()


# ------------------------------------------------------------------ adapters in SQL
AGENT_OF = "'agent_' || chr(CAST(97 + ({x}) % 5 AS INTEGER))"


def agent(x: str) -> str:
    return AGENT_OF.format(x=x)


CHAT_META = (
    "'[' || CASE event_id % 3 "
    "WHEN 0 THEN strftime(ts, '%-H:%M') "
    "WHEN 1 THEN strftime(ts, '%-I:%M') || chr(8239) || "
    "CASE WHEN hour(ts) < 12 THEN 'a.' || chr(160) || 'm.' ELSE 'p.' || chr(160) || 'm.' END "
    "ELSE strftime(ts, '%-I:%M %p') END || ', ' || strftime(ts, '%-d/%-m/%Y') || ']' || "
    "CASE WHEN event_type = 'purchase' THEN ' You:' WHEN event_type = 'error' THEN '' "
    "ELSE ' contact ' || CAST(user_id AS VARCHAR) || ':' END"
)

CHAT_ROWS = f"""
chat AS (
  SELECT {agent('user_id')} AS executive,
         'contact ' || CAST(user_id AS VARCHAR) AS contact,
         {CHAT_META} AS meta,
         concat_ws(' ', event_type, props) AS text,
         event_type, props, ts, user_id, event_id,
         date_trunc('minute', ts) AS dt,
         CASE WHEN event_type = 'purchase' THEN 'You' WHEN event_type = 'error' THEN NULL
              ELSE 'contact ' || CAST(user_id AS VARCHAR) END AS author,
         CASE WHEN event_type = 'purchase' THEN 'owner' WHEN event_type = 'error' THEN NULL
              ELSE 'contact' END AS role
  FROM events)"""

INBOX_ROWS = f"""
inbox AS (
  SELECT event_id AS message_id, user_id * 100 + day(ts) AS conversation_id, user_id % 7 AS inbox_id,
         CASE WHEN event_type IN ('purchase', 'error') THEN 'User' ELSE 'Contact' END AS sender_type,
         ts - INTERVAL 5 HOUR AS sent_at,
         'contact ' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 10 = 0 THEN ' (GROUP)' ELSE '' END AS contact_name,
         CASE WHEN event_type = 'error' THEN 'Asignado a agent por Automation System' ELSE event_type END AS content
  FROM events WHERE ts IS NOT NULL),
k AS (
  SELECT inbox.*, 'agent_' || chr(CAST(97 + inbox_id AS INTEGER)) AS executive,
         coalesce(contains(content, 'Asignado a') AND contains(content, 'por Automation System'), false) AS is_sys,
         row_number() OVER (PARTITION BY conversation_id ORDER BY sent_at, message_id, sender_type, content) AS pos
  FROM inbox WHERE inbox_id BETWEEN 0 AND 4),
fr AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT k.*, row_number() OVER (PARTITION BY conversation_id ORDER BY sent_at, message_id, sender_type, content) AS rn
    FROM k WHERE NOT is_sys) WHERE rn = 1)"""

CAPTURE_LOG = """
capture_log AS (
  SELECT 'contact ' || CAST(user_id AS VARCHAR) AS contact,
         CASE WHEN user_id % 9 = 0 THEN 'timed_out' WHEN user_id % 13 = 0 THEN 'error'
              WHEN user_id % 17 = 0 THEN 'excluded' ELSE 'ok' END AS status,
         count(*) AS n
  FROM events WHERE user_id % 4 <> 0 GROUP BY user_id),
log AS (
  SELECT contact, status, CAST(CASE WHEN status IN ('ok', 'timed_out') THEN n ELSE 0 END AS BIGINT) AS messages
  FROM capture_log)"""

EXCLUDED = "(VALUES ('Contact 7'), ('  contact   14 '), ('CONTACT 21'), ('Team Room')) AS ex(title)"
NORM = "lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


def norm(x: str) -> str:
    return NORM.format(x=x)


def first_response_sql(msgs_cte: str) -> str:
    """Chat first-response rule over a CTE ``m(executive, contact, dt, role)``."""
    return f"""
WITH {msgs_cte},
f AS (SELECT executive, contact, min(dt) AS first_dt FROM m GROUP BY executive, contact),
c AS (
  SELECT m.executive, m.contact, f.first_dt,
         coalesce(bool_or(m.role = 'contact' AND m.dt = f.first_dt), false) AS has_in,
         min(CASE WHEN m.role = 'owner' AND m.dt > f.first_dt THEN m.dt END) AS reply
  FROM m JOIN f ON m.executive = f.executive AND m.contact = f.contact
  GROUP BY m.executive, m.contact, f.first_dt)
SELECT executive, contact AS lead_id, has_in AS has_inbound,
       CASE WHEN has_in THEN reply IS NOT NULL ELSE true END AS has_outbound,
       CAST(CASE WHEN has_in THEN first_dt END AS DATE) AS in_date,
       strftime(CASE WHEN has_in THEN first_dt END, '%H:%M:%S') AS in_time,
       CAST(CASE WHEN has_in THEN reply ELSE first_dt END AS DATE) AS out_date,
       strftime(CASE WHEN has_in THEN reply ELSE first_dt END, '%H:%M:%S') AS out_time
FROM c"""


CHAT_M = CHAT_ROWS + ",\nm AS (SELECT executive, contact, dt, role FROM chat)"
CONV_M = f"""
m AS (
  SELECT {agent('conv_id')} AS executive, 'conv ' || CAST(conv_id AS VARCHAR) AS contact,
         TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(conv_id AS INTEGER)) + to_minutes(CAST(turn * 7 AS INTEGER)) AS dt,
         CASE WHEN role = 'assistant' THEN 'owner' WHEN role = 'user' THEN 'contact' END AS role
  FROM conversations)"""

# ------------------------------------------------------------------ message queries
oracle("meta_parse", f"""
WITH {CHAT_ROWS}
SELECT executive, contact, dt, strftime(dt, '%H:%M:%S') AS msg_time, author FROM chat""")

oracle("chat_first_response", first_response_sql(CHAT_M))
oracle("conversation_first_response", first_response_sql(CONV_M))

oracle("chat_rows_csv", first_response_sql(CHAT_M))

oracle("inbound_counts", f"""
WITH r AS ({first_response_sql(CHAT_M)})
SELECT has_inbound, count(*) AS chats, CAST(grouping(has_inbound) AS BOOLEAN) AS is_total
FROM r GROUP BY ROLLUP (has_inbound)""")

_INBOX_SELECT = """
SELECT fr.executive, CAST(fr.conversation_id AS VARCHAR) AS lead_id,
       fr.sender_type = 'Contact' AS has_inbound, rp.reply_at IS NOT NULL AS has_outbound,
       CAST(fr.sent_at AS DATE) AS in_date, strftime(fr.sent_at, '%H:%M:%S') AS in_time,
       CAST(rp.reply_at AS DATE) AS out_date, strftime(rp.reply_at, '%H:%M:%S') AS out_time
FROM fr LEFT JOIN rp ON fr.conversation_id = rp.conversation_id
WHERE NOT ends_with(trim(fr.contact_name), '(GROUP)')"""

_REPLY_REFERENCE = """
rp AS (
  SELECT conversation_id, sent_at AS reply_at FROM (
    SELECT k.*, row_number() OVER (PARTITION BY conversation_id ORDER BY sent_at, message_id, sender_type, content) AS rn
    FROM k WHERE sender_type = 'User' AND pos > 1) WHERE rn = 1)"""

_REPLY_STRICT = """
rp AS (
  SELECT conversation_id, sent_at AS reply_at FROM (
    SELECT k.conversation_id, k.sent_at,
           row_number() OVER (PARTITION BY k.conversation_id ORDER BY k.sent_at, k.message_id) AS rn
    FROM k JOIN fr f ON k.conversation_id = f.conversation_id
    WHERE k.sender_type = 'User' AND NOT k.is_sys
      AND (k.sent_at > f.sent_at OR (k.sent_at = f.sent_at AND k.message_id > f.message_id))) WHERE rn = 1)"""

oracle("inbox_first_response", f"WITH {INBOX_ROWS},{_REPLY_REFERENCE}{_INBOX_SELECT}")
oracle("inbox_first_response_strict", f"WITH {INBOX_ROWS},{_REPLY_STRICT}{_INBOX_SELECT}")
oracle("inbox_date_window", f"""WITH {INBOX_ROWS},{_REPLY_REFERENCE}{_INBOX_SELECT}
  AND fr.sent_at >= TIMESTAMP '2024-01-08 06:00:00' AND fr.sent_at <= TIMESTAMP '2024-01-21 00:00:00'""")

oracle("message_dedupe", f"""
WITH {CHAT_ROWS},
r AS (
  SELECT contact, meta,
         CASE WHEN starts_with(text, 'error') THEN '[AUDIO]' ELSE trim(text) END AS text,
         CASE WHEN starts_with(text, 'error') THEN substr(replace(trim(text), chr(10), ' '), 1, 80) ELSE '' END AS preview
  FROM chat)
SELECT contact, meta, text FROM (SELECT DISTINCT contact, meta, text, preview FROM r WHERE meta <> '' OR text <> '')""")

oracle("exclude_chats", f"""
WITH {CHAT_ROWS}
SELECT DISTINCT contact AS title FROM chat
WHERE {norm('contact')} NOT IN (SELECT {norm('title')} FROM {EXCLUDED})""")

oracle("recent_chats", f"""
WITH {CHAT_ROWS}
SELECT contact, max(dt) AS last_dt FROM chat
WHERE {norm('contact')} NOT IN (SELECT {norm('title')} FROM {EXCLUDED})
GROUP BY contact ORDER BY last_dt DESC, contact LIMIT 25""")

oracle("capture_policy", f"""
WITH {CHAT_ROWS},{CAPTURE_LOG}
SELECT contact, dt, author, false AS partial FROM chat
WHERE contact NOT IN (SELECT contact FROM log WHERE status = 'timed_out')""")

oracle("capture_policy_keep_partial", f"""
WITH {CHAT_ROWS},{CAPTURE_LOG}
SELECT contact, dt, author, contact IN (SELECT contact FROM log WHERE status = 'timed_out') AS partial FROM chat""")

oracle("skip_processed", """
SELECT DISTINCT 'contact ' || CAST(user_id AS VARCHAR) AS contact FROM events WHERE user_id % 4 = 0""")

oracle("capture_summary", f"""
WITH {CAPTURE_LOG}
SELECT status, count(*) AS chats, CAST(sum(messages) AS BIGINT) AS messages,
       CAST(grouping(status) AS BOOLEAN) AS is_total
FROM log GROUP BY ROLLUP (status)""")

_LINK = '<a\\s[^>]*?\\bhref="([^"]*)"[^>]*>([^<]*)</a>'
oracle("page_messages", f"""
WITH n AS (
  SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS v, regexp_extract_all(html, '{_LINK}', 2) AS t
  FROM pages),
e AS (SELECT page_id, unnest(range(len(v))) AS pos, unnest(v) AS value, unnest(t) AS text FROM n)
SELECT page_id, CAST(pos AS BIGINT) AS pos, value, text,
       CASE WHEN length(trim(text)) > 0 THEN trim(text)
            WHEN regexp_matches(lower(value), '\\.(mp3|ogg|opus|m4a|wav)$') THEN '[AUDIO]'
            ELSE '[ADJUNTO]' END AS message
FROM e""")

# A bubble's row gives its media message; the element with the meta gives the meta with its text (empty for audio).
oracle("chat_page_messages", """
WITH c AS (SELECT 'conv ' || conv_id AS contact, turn % 5 AS k, '[turn ' || turn || '] x > y:' AS meta,
                  translate(coalesce(text, ''), '<>&', '   ') AS t FROM conversations),
m AS (
  SELECT contact, meta, trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text, '' AS preview FROM c WHERE k > 2
  UNION ALL SELECT contact, meta, '', '' FROM c WHERE k = 0
  UNION ALL SELECT contact, meta, '[AUDIO]', '' FROM c WHERE k = 0
  UNION ALL SELECT contact, '', '[ADJUNTO]', replace(trim(substr(t, 1, 20), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), chr(10), ' ') FROM c WHERE k = 1
  UNION ALL SELECT contact, '', '[ADJUNTO]', '' FROM c WHERE k = 2)
SELECT contact, meta, text FROM (SELECT DISTINCT * FROM m)""")

oracle("safe_name", f"""
WITH {CHAT_ROWS},
n AS (SELECT DISTINCT contact || ' / ' || executive || ' #1' AS name FROM chat),
s AS (SELECT name, replace(trim(regexp_replace(name, '[^\\p{{L}}\\p{{N}} _-]', '', 'g')), ' ', '-') AS safe FROM n)
SELECT name, CASE WHEN length(safe) > 0 THEN safe ELSE 'todos_los_chats' END AS safe FROM s""")

oracle("date_in_text", f"""
WITH {CHAT_ROWS}
SELECT rtrim(meta) AS meta, CAST(ts AS DATE) AS found FROM chat""")

oracle("chat_export_scan", ORACLE["meta_parse"].replace("SELECT executive,", "SELECT 'Ana María 5% #1+ ' || executive AS executive,"))

oracle("messages_csv_roundtrip", f"""
WITH {CHAT_ROWS}
SELECT DISTINCT contact, meta, text || ' said "hi", ok;' || chr(10) || '"x", \\ end' AS text FROM chat""")

# Files are (inbox, message_id % 64); a file of inbox 2 holding a row with
# message_id % 97 = 0 (unparsable timestamp) is skipped whole.
oracle("inbox_scan_skip_bad_files", f"""WITH {INBOX_ROWS},{_REPLY_REFERENCE}{_INBOX_SELECT}""".replace(
    "FROM inbox WHERE inbox_id BETWEEN 0 AND 4",
    "FROM inbox WHERE inbox_id BETWEEN 0 AND 4 AND NOT (inbox_id = 2 AND message_id % 64 IN "
    "(SELECT DISTINCT message_id % 64 FROM inbox WHERE inbox_id = 2 AND message_id % 97 = 0))").replace(
    "CAST(fr.conversation_id AS VARCHAR) AS lead_id",
    "CASE WHEN fr.conversation_id % 3 = 0 THEN 'A-' ELSE '' END || CAST(fr.conversation_id AS VARCHAR) AS lead_id"))

oracle("export_by_executive", f"""
WITH {INBOX_ROWS},{_REPLY_REFERENCE}{_INBOX_SELECT}""")

oracle("stream_message_dedupe", f"""
WITH {CHAT_ROWS}
SELECT DISTINCT contact, meta, text FROM chat""")



def sessions_sql(keys: str, gap: str, select: str, more_ctes: str = "") -> str:
    """Gap sessions over CHAT_ROWS (events exactly ``gap`` apart stay in one session)."""
    return f"""
WITH {CHAT_ROWS},
s AS (
  SELECT chat.*, CASE WHEN lag(dt) OVER (PARTITION BY {keys} ORDER BY dt, event_id) IS NULL
           OR dt > lag(dt) OVER (PARTITION BY {keys} ORDER BY dt, event_id) + INTERVAL {gap} THEN 1 ELSE 0 END AS new
  FROM chat),
g AS (
  SELECT s.*, sum(new) OVER (PARTITION BY {keys} ORDER BY dt, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s),
sess AS (
  SELECT {keys}, sid, min(dt) AS first_ts, max(dt) + INTERVAL {gap} AS session_end, count(*) AS messages
  FROM g GROUP BY {keys}, sid){more_ctes}
{select}"""


oracle("stream_sessions", sessions_sql(
    "contact", "30 MINUTE",
    "SELECT contact, first_ts AS session_start, session_end, messages FROM sess"))

oracle("stream_first_response", sessions_sql(
    "executive, contact", "2 HOUR", """
SELECT executive, contact, first_ts AS session_start, has_in AS has_inbound,
       CASE WHEN has_in THEN reply IS NOT NULL ELSE true END AS has_outbound,
       CASE WHEN has_in THEN first_ts END AS in_ts,
       CASE WHEN has_in THEN reply ELSE first_ts END AS out_ts
FROM fr""", """,
fr AS (
  SELECT g.executive, g.contact, sess.first_ts,
         coalesce(bool_or(g.role = 'contact' AND g.dt = sess.first_ts), false) AS has_in,
         min(CASE WHEN g.role = 'owner' AND g.dt > sess.first_ts THEN g.dt END) AS reply
  FROM g JOIN sess ON g.executive = sess.executive AND g.contact = sess.contact AND g.sid = sess.sid
  GROUP BY g.executive, g.contact, sess.sid, sess.first_ts)"""))

oracle("stream_raw_exports", f"""
WITH {CHAT_ROWS}
SELECT executive, contact, CASE WHEN event_id % 50 = 0 THEN '? ' ELSE '' END || meta AS meta, text || chr(10) || 'second "line", end' AS text,
       CASE WHEN event_id % 50 <> 0 THEN dt END AS dt, CASE WHEN event_id % 50 <> 0 THEN role END AS role,
       CASE WHEN event_id % 50 = 0 THEN 'meta' END AS reason FROM chat""")
