"""Collected-message rules: dedupe, chat eligibility, exclusion, capture policy, summaries,
and message nodes extracted from stored HTML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import is_valid_title, media_text, norm_title, preview, strip
from .joins import bounded_broadcast


def dedupe_messages(msgs: DataFrame) -> DataFrame:
    """(contact, meta, text[, kind, raw_text]) -> unique collected messages.

    Rows with empty meta and empty text are dropped. A text message is
    identified by contact+meta+text; a media message (``kind`` set) also by
    the 80-character preview of its bubble text, so two media bubbles with the
    same meta stay apart. ``dropDuplicates`` plans as a partial+final
    aggregate: one shuffle, hot chats merged map-side.
    """
    df = msgs
    for c in ("contact", "meta", "text"):
        df = df.withColumn(c, strip(F.coalesce(F.col(c), F.lit(""))))
    has_kind = "kind" in df.columns
    if has_kind:
        raw = F.col("raw_text") if "raw_text" in df.columns else F.col("text")
        df = df.withColumn(
            "_preview",
            F.when(F.coalesce(F.length(F.col("kind")), F.lit(0)) > 0, preview(raw)).otherwise(F.lit("")),
        ).withColumn("text", media_text(F.col("text"), F.col("kind")))
    else:
        df = df.withColumn("_preview", F.lit(""))
    df = df.where((F.length("meta") > 0) | (F.length("text") > 0))
    return df.dropDuplicates(["contact", "meta", "text", "_preview"]).select("contact", "meta", "text")


def eligible_chats(titles: DataFrame, excluded: DataFrame, title_col: str = "contact") -> DataFrame:
    """Distinct valid chat titles that are not on the exclusion list (compared
    after whitespace collapse + lower-case)."""
    ex = bounded_broadcast(excluded.select(norm_title(F.col("title")).alias("_t")).distinct())
    t = titles.select(strip(F.col(title_col)).alias("title")).where(is_valid_title(F.col("title"))).distinct()
    return t.join(ex, norm_title(F.col("title")) == F.col("_t"), "left_anti")


def recent_chats(msgs: DataFrame, excluded: DataFrame, n: int = 250) -> DataFrame:
    """The ``n`` most recently active eligible chats (top-k report: the limit is the feature)."""
    title = strip(F.col("contact"))
    last = (msgs.groupBy("contact").agg(F.max("dt").alias("last_dt")).withColumn("contact", title)
            .where(is_valid_title(F.col("contact"))).groupBy("contact").agg(F.max("last_dt").alias("last_dt")))
    ex = bounded_broadcast(excluded.select(norm_title(F.col("title")).alias("_t")).distinct())
    return (last.join(ex, norm_title(F.col("contact")) == F.col("_t"), "left_anti")
            .orderBy(F.col("last_dt").desc_nulls_last(), F.col("contact")).limit(n))


def apply_capture_policy(msgs: DataFrame, capture_log: DataFrame, keep_partial: bool) -> DataFrame:
    """Messages under the capture policy: chats that hit the time limit are dropped
    (``keep_partial=False``) or kept and flagged in ``partial``. Every other chat
    passes, in the log or not; a chat logged several times counts once."""
    late = bounded_broadcast(capture_log.where(F.col("status") == "timed_out").select("contact").distinct())
    if not keep_partial:
        return msgs.join(late, "contact", "left_anti").withColumn("partial", F.lit(False))
    flagged = late.withColumn("_late", F.lit(True))
    return msgs.join(flagged, "contact", "left").withColumn("partial", F.coalesce("_late", F.lit(False))).drop("_late")


def skip_processed(candidates: DataFrame, capture_log: DataFrame, col: str = "contact") -> DataFrame:
    """Candidates not yet in the capture log (any status counts as processed)."""
    return candidates.join(capture_log.select(F.col("contact").alias(col)), col, "left_anti")


def capture_summary(capture_log: DataFrame) -> DataFrame:
    """Chats and collected messages per status, plus a total row (status null)."""
    return capture_log.rollup("status").agg(
        F.count(F.lit(1)).alias("chats"),
        F.sum(F.coalesce(F.col("messages"), F.lit(0))).cast("bigint").alias("messages"),
        F.grouping("status").cast("boolean").alias("is_total"),
    )


def chats_with_status(capture_log: DataFrame, status: str = "timed_out") -> DataFrame:
    """The chats of one capture status (e.g. the timed-out list of a run summary),
    as rows - a filter, never a list gathered in one task."""
    return capture_log.where(F.col("status") == status).select("contact", "messages")


# A comment, a script or style with its text, a tag (a ">" in a quoted value is part of it), a run of text, a bare "<".
_TOKEN = r"""(?is)<!--.*?(?:-->|$)|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|$)|<[!?][^>]*>?|</?[a-z][^\s/>]*(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""
_TAG = r"^</?[a-zA-Z]"
_RAW = r"(?i)^<(?:script|style)\b"
_VOID = "area base br col embed hr img input link meta param source track wbr".split()


def attribute_value(tag, name: str):
    """Value of an attribute of a tag (null: not there): in either quotes or bare; names in any case. All attributes are
    read in turn, so the text of another one's value is never taken for it."""
    pat = r"""(?is)\s([^\s=>"'/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    names = F.transform(F.regexp_extract_all(tag, F.lit(pat), F.lit(1)), F.lower)
    at = F.array_position(names, name.lower())
    value = F.get(F.regexp_extract_all(tag, F.lit(pat), F.lit(2)), (at - 1).cast("int"))
    return F.when(at > 0, F.regexp_replace(value, r"""^["']|["']$""", ""))


def page_tokens(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, tok: the page cut into tokens (one row a page id)."""
    return pages.select(id_col, F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_TOKEN), F.lit(0)).alias("tok"))


def elements(tokens: DataFrame, id_col: str = "page_id", name: str | None = None) -> DataFrame:
    """(id, at, end, tag) of the elements (of one name, if given): places of an element's start tag and end tag among the page's tokens (the end of the page
    where there is none). Tags are balanced name by name: an element ends where as many of its name
    are open as before it, so it may hold others of its name and unclosed ones of other names."""
    wanted = F.col("tag").rlike(rf"(?i)^</?{name}[\s/>]" if name else _TAG)
    tags = (tokens.select(id_col, F.size("tok").alias("n"), F.posexplode("tok").alias("at", "tag"))
            .where(wanted & ~F.col("tag").rlike(_RAW))
            .withColumn("name", F.lower(F.regexp_extract("tag", r"^</?([a-zA-Z][^\s/>]*)", 1)))
            .withColumn("closes", F.startswith("tag", F.lit("</"))))
    alone = F.col("name").isin(_VOID) | F.endswith("tag", F.lit("/>"))
    single = tags.where(~F.col("closes") & alone).select(id_col, "at", F.col("at").alias("end"), "tag")
    along = Window.partitionBy(id_col, "name").orderBy("at")
    pairs = tags.where(F.col("closes") | ~alone).withColumn("_open", F.sum(F.when(F.col("closes"), -1).otherwise(1)).over(along))
    # Stray end tags would lower the level for good: the least number so far is where nothing is open.
    ground = F.least(F.lit(0), F.min("_open").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    level = F.col("_open") + F.col("closes").cast("int") - ground
    same = Window.partitionBy(id_col, "name", "_level").orderBy("at")
    pairs = pairs.withColumn("_level", level).withColumn("_next", F.lead(F.when(F.col("closes"), F.col("at"))).over(same))
    return pairs.where(~F.col("closes")).select(id_col, "at", F.coalesce("_next", "n").alias("end"), "tag").unionByName(single)


def _inside():
    """Tokens between an element's tags."""
    return F.slice("tok", F.col("at") + 2, F.greatest(F.col("end") - F.col("at") - 1, F.lit(0)))


def _text():
    return F.array_join(F.filter(_inside(), lambda x: ~F.startswith(x, F.lit("<")) | (x == "<")), "")


def _numbered(nodes: DataFrame, id_col: str) -> DataFrame:
    place = Window.partitionBy(id_col).orderBy("at")
    return nodes.withColumn("pos", (F.row_number().over(place) - 1).cast("bigint"))


def page_nodes(pages: DataFrame, attribute: str = "href", id_col: str = "page_id",
               html_col: str = "html", tag: str | None = "a") -> DataFrame:
    """Elements with an attribute of each page: (id, pos, value, text), pos from 0 in page order. Names in
    any case, values in either quotes or bare; the text is the content without tags, comments, scripts and styles,
    that of inner elements included (which are nodes of their own too). ``tag=None`` takes
    elements of any name (the message nodes of a stored chat page carry their meta in an attribute)."""
    tokens = page_tokens(pages, id_col, html_col)
    found = elements(tokens, id_col, tag).withColumn("value", attribute_value(F.col("tag"), attribute)).where(F.col("value").isNotNull())
    return _numbered(found.join(tokens, id_col), id_col).select(id_col, "pos", "value", _text().alias("text"))


def node_messages(nodes: DataFrame) -> DataFrame:
    """Message text of extracted nodes: the node text, or a media placeholder when
    the node has none (audio file links -> [AUDIO], other links -> [ADJUNTO])."""
    kind = F.when(F.lower(F.col("value")).rlike(r"\.(mp3|ogg|opus|m4a|wav)$"), F.lit("AUDIO")).otherwise(F.lit("ADJUNTO"))
    return nodes.withColumn("message", media_text(F.col("text"), kind))


def media_kind(inside, text, markers=S.MEDIA_MARKERS):
    """AUDIO or ADJUNTO by the marker elements among an element's tokens, ADJUNTO for a picture without text, else null."""
    kind = None
    for attribute, words, whole, button, name in markers:
        def marks(x):
            value = attribute_value(x, attribute)
            hit = value.isin(words) if whole else reduce(lambda a, b: a | b, [F.contains(value, F.lit(w)) for w in words])
            return F.coalesce(hit & (attribute_value(x, "role") == "button") if button else hit, F.lit(False))
        found = F.exists(F.filter(inside, lambda x: F.contains(F.lower(x), F.lit(attribute))), marks)
        kind = F.when(found, name) if kind is None else kind.when(found, name)
    picture = F.exists(inside, lambda x: x.rlike(r"(?i)^<img\b"))
    return kind.when((F.length(strip(text)) == 0) & picture, "ADJUNTO")


def chat_page_messages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Messages of stored chat pages: (id, pos, meta, text, kind, raw_text), pos being the place in the page. Every
    element with a meta attribute that has a meta or a text is a message; so is every bubble (an element of the
    row role) that holds media, with the meta of its first inner element that has one, the kind's placeholder as
    its text (``dedupe_messages``) and its own text as ``raw_text``."""
    tokens = page_tokens(pages, id_col, html_col)
    found = elements(tokens, id_col).select(
        id_col, "at", "end", attribute_value(F.col("tag"), S.META_ATTRIBUTE).alias("_meta"),
        (attribute_value(F.col("tag"), "role") == S.BUBBLE_ROLE).alias("_bubble")).where("_meta is not null or _bubble")
    d = found.join(tokens, id_col).withColumn("_in", _inside()).withColumn("_t", strip(_text()))
    plain = d.where(F.col("_meta").isNotNull()).select(
        id_col, F.col("at").alias("pos"), strip("_meta").alias("meta"), F.col("_t").alias("text"), F.lit(None).cast("string").alias("kind"),
        F.col("_t").alias("raw_text")).where((F.length("meta") > 0) | (F.length("text") > 0))
    first = F.get(F.filter(F.transform(F.filter("_in", lambda x: F.contains(F.lower(x), F.lit(S.META_ATTRIBUTE))),
                                       lambda x: attribute_value(x, S.META_ATTRIBUTE)), lambda v: v.isNotNull()), F.lit(0))
    media = d.where("_bubble").withColumn("kind", media_kind(F.col("_in"), F.col("_t"))).where(F.col("kind").isNotNull()).select(
        id_col, F.col("at").alias("pos"), F.coalesce(strip(first), F.lit("")).alias("meta"), F.lit("").alias("text"), "kind", F.col("_t").alias("raw_text"))
    return plain.unionByName(media)
