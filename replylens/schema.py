"""Canonical schemas, header maps and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the behaviour being rebuilt; stated as plain text)
# --------------------------------------------------------------------------

# Spanish CSV headers of lead files, in the order of the documented format,
# mapped to canonical column names.
LEAD_HEADERS = {
    "Ejecutivo": "executive",
    "ID_LEAD": "lead_id",
    "Mensaje Entrante": "has_inbound",
    "Mensaje Saliente": "has_outbound",
    "Fecha Entrante": "in_date",
    "Hora Entrante": "in_time",
    "Fecha Saliente": "out_date",
    "Hora Saliente": "out_time",
    "Tiempo Respuesta (min)": "response_time",
    "Score Tiempo Respuesta": "score",
    "Segmento Horario Entrada": "entry_segment",
}
# Alternative id column accepted in new lead files (used only when ID_LEAD is absent).
ALT_LEAD_ID_HEADER = "lead_id"

# Columns taken from a new lead file (everything else in it is ignored).
NEW_LEAD_HEADERS = [
    "Ejecutivo", "ID_LEAD", "lead_id", "Mensaje Entrante", "Mensaje Saliente",
    "Fecha Entrante", "Hora Entrante", "Fecha Saliente", "Hora Saliente",
]

# Text read as missing in a cell (the common CSV reader defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Lower-cased words treated as an empty date/time cell by the normalisers.
EMPTY_WORDS = ["nan", "nat", "none", "null"]
# Relative day words.
TODAY_WORD = "hoy"
YESTERDAY_WORD = "ayer"

# Response-time score: (code, label, inclusive upper bound in seconds).
# "automatic" is strictly below its bound; the last bucket is open-ended.
SCORE_BUCKETS = [
    ("automatic", "⚙️ Automático", 60),
    ("excellent", "🟢 Excelente", 300),
    ("good", "🟡 Bueno", 900),
    ("regular", "🟠 Regular", 3600),
    ("slow", "🔴 Lento", 86400),
    ("very_slow", "⚫ Muy Lento", None),
]
SCORE_OUTBOUND = ("outbound", "⚠️ Outbound")
SCORE_NOT_ANSWERED = ("not_answered", "❌ No respondido")

# Hour-of-day segment of the inbound message: (code, label, hour upper bound, exclusive).
SEGMENTS = [
    ("early_morning", "🌙 Madrugada", 6),
    ("morning_off", "🌤 Mañana no laborable", 9),
    ("morning_work", "☀️ Mañana laborable", 13),
    ("afternoon", "🌇 Tarde", 18),
    ("evening", "🌆 Noche", 23),
    ("late_evening", "🌒 Noche tarde", 24),
]
SEGMENT_NOT_REGISTERED = ("not_registered", "❌ No registrado")

# Default shift hours by shift keyword.
SHIFT_HOURS = [
    ("mañana", "09:00", "18:00"),
    ("manana", "09:00", "18:00"),
    ("tarde", "14:00", "22:00"),
]
# Shift keywords: "tarde" is tested first, then the two spellings of "mañana".
SHIFT_AFTERNOON = "tarde"
SHIFT_MORNING = "mañana"
SHIFT_MORNING_PLAIN = "manana"

# Automatic-assignment system message markers (both must be present).
SYSTEM_MARKERS = ("Asignado a", "por Automation System")
# Contact-name suffix of group conversations.
GROUP_SUFFIX = "(GROUP)"
# Sender types of the inbox export.
SENDER_CONTACT = "Contact"
SENDER_AGENT = "User"
# Generic author names that always mean "the account owner".
OWNER_WORDS = ["Tú", "You", "Me"]
# Reserved chat-list titles that are never chats, and the title length limit.
RESERVED_TITLES = ["Archivados", "WhatsApp"]
MAX_TITLE_LEN = 60
# Media placeholders for messages without text.
MEDIA_AUDIO = "[AUDIO]"
MEDIA_ATTACHMENT = "[ADJUNTO]"
PREVIEW_CHARS = 80
# Marker elements of a message bubble: (attribute, words its value is or holds, whether it is them, needs role=button, kind).
MEDIA_MARKERS = [
    ("data-icon", ["audio-play", "ptt-play"], True, False, "AUDIO"),
    ("aria-label", ["Abrir foto", "Descargar", "Download"], False, True, "ADJUNTO"),
]
META_ATTRIBUTE = "data-pre-plain-text"
BUBBLE_ROLE = "row"
# Yes/no flag words of lead files.
FLAG_YES = "SI"
FLAG_NO = "NO"
# Default export name when a name has no usable character.
DEFAULT_EXPORT_NAME = "todos_los_chats"
# Chat-export meta prefix: "[h:mm am/pm, n/n/yyyy] author:" (author optional).
META_PATTERN = (
    r"(?iU)^\[(\d{1,2}):(\d{2})\s*((?:a\.?\s?m\.?|p\.?\s?m\.?|am|pm))?\s*,\s*"
    r"(\d{1,2})/(\d{1,2})/(\d{4})\]\s*(?:([^:]+):)?"
)
# Date inside free text, d/m/yy or d/m/yyyy.
DATE_IN_TEXT_PATTERN = r"\b(\d{1,2})/(\d{1,2})/(\d{2,4})\b"
# Narrow and plain no-break spaces seen in chat metadata.
NBSP_CHARS = "\u00a0\u202f"
# Accented lower-case letters and their plain forms (closed alphabet of the
# schedule sheets: Spanish and other Latin-1 letters).
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçý"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncy"

# --------------------------------------------------------------------------
# Canonical schemas
# --------------------------------------------------------------------------

# Inbox message export (after typing).
INBOX_SCHEMA = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("conversation_id", T.StringType()),
    T.StructField("inbox_id", T.LongType()),
    T.StructField("sender_type", T.StringType()),
    T.StructField("sent_at", T.TimestampNTZType()),
    T.StructField("contact_name", T.StringType()),
    T.StructField("content", T.StringType()),
])

# Date-text patterns reported by the profile, in report order, and those the parsers accept.
DATE_PATTERNS = [
    ("YYYY-MM-DD", r"^\d{4}-\d{2}-\d{2}$"),
    ("DD-MM-YYYY", r"^\d{2}-\d{2}-\d{4}$"),
    ("DD/MM/YYYY", r"^\d{2}/\d{2}/\d{4}$"),
    ("YYYY-MM-DD HH:MM:SS", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"),
    ("DD/MM/YYYY HH:MM:SS", r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$"),
]
ISO_DATE = DATE_PATTERNS[0][1]
DMY_STRICT = DATE_PATTERNS[2][1]
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}$"
DMY_LENIENT = r"^\d{1,2}/\d{1,2}/\d{4}$"
ISO_DATE_LOOSE = r"^\d{4}-\d{1,2}-\d{1,2}$"

# Full lead schema after consolidation and scoring.
LEAD_SCHEMA = T.StructType([
    T.StructField("executive", T.StringType()),
    T.StructField("lead_id", T.StringType()),
    T.StructField("has_inbound", T.BooleanType()),
    T.StructField("has_outbound", T.BooleanType()),
    T.StructField("in_date", T.DateType()),
    T.StructField("in_time", T.StringType()),
    T.StructField("out_date", T.DateType()),
    T.StructField("out_time", T.StringType()),
    T.StructField("response_time", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("entry_segment", T.StringType()),
    T.StructField("source_rank", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
])

# Calendar rules: null fields are wildcards; lowest priority wins.
# action: "off" (no shift that day), "hours" (start/end given), "default"
# (hours of the shift keyword), "cutoff" (global early close at `end`).
SHIFT_RULE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("executive", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("weekday_from", T.IntegerType()),
    T.StructField("weekday_to", T.IntegerType()),
    T.StructField("shift", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
])

