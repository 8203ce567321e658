"""CSV sources: header-grouped multi-file scans, history snapshots, inbox and chat exports.

Spark's CSV reader binds columns by position across files, so files whose
headers differ would mix columns. ``scan_csv`` therefore profiles the files in one
Spark job (the whole first line of every file, and whether its records go on over line
breaks), groups the files by header, reads each group with its own all-string
schema and unions the groups by name. The driver gets the distinct headers and the
file names - file metadata, like any file listing - never data rows. Files without
broken records are split over tasks by the CSV reader; the others are split too, their
records put together by ``csv_records``.
"""

from __future__ import annotations

import csv
import logging
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import canonical_id, null_if_token, strip
from ..operators.joins import bounded_broadcast
from ..sinks.snapshots import current
from .csv_records import _literal_path, file_profile, records, text_lines

log = logging.getLogger(__name__)

# Names of the columns a scan adds; a file's own column of such a name gets a number.
FILE, PATH = "__file", "__path"


def _ci_glob(ext: str) -> str:
    """Case-insensitive glob for a file extension ('.csv' -> '*.[cC][sS][vV]')."""
    return "*" + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in ext)


def existing(spark: SparkSession, folders) -> list[str]:
    """Folders that exist (missing ones are logged and skipped)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for f in ([folders] if isinstance(folders, str) else list(folders)):
        p = jvm.org.apache.hadoop.fs.Path(f)
        if p.getFileSystem(conf).exists(p):
            out.append(f)
        else:
            log.warning("folder does not exist, skipped: %s", f)
    return out


def _list_files(spark: SparkSession, roots: list[str], ext: str, recursive: bool) -> list[str]:
    """Plain (not URL-encoded) paths of the files with the extension, hidden ones left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for root in roots:
        p = jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(conf)
        base = fs.getFileStatus(p).getPath().toString()
        it = fs.listFiles(p, recursive)
        while it.hasNext():
            st = it.next()
            path = st.getPath().toString()
            inside = path[len(base):] if path.startswith(base) else path
            if st.getLen() and path.lower().endswith(ext.lower()) and not any(
                    x[:1] in (".", "_") and "=" not in x for x in inside.split("/")):
                out.append(path)
    return sorted(set(out))


def header_groups(spark: SparkSession, folders, ext: str = ".csv", recursive: bool = True) -> list[tuple[str, bool, list[str]]]:
    """[(header, broken, [files])] of the CSV files under ``folders``; empty files are absent. ``broken``: some
    record of the files goes on over a line break. One job over the files' lines, whatever their number."""
    roots = existing(spark, folders)
    files = _list_files(spark, roots, ext, recursive) if roots else []
    if not files:
        return []
    heads = file_profile(spark, files)
    plain = heads.groupBy("head", "broken").agg(F.collect_list("path").alias("files")).collect()
    groups: dict[tuple[str, bool], list[str]] = {}
    for r in plain:
        paths = [unquote(p) for p in r["files"]]
        header = r["head"] or ""
        if r["broken"] and header.count('"') % 2:              # the header itself holds a line break
            whole = records(text_lines(spark, paths)).where("first").select("path", "record").collect()
            for w in whole:
                groups.setdefault((w["record"], True), []).append(unquote(w["path"]))
        else:
            groups.setdefault((header, r["broken"]), []).extend(paths)
    return sorted((h, broken, sorted(fs)) for (h, broken), fs in groups.items())


def _split_header(header: str) -> list[str]:
    """Column names of a header line. A name that occurs again (in any case, as Spark
    compares names) gets a number, and an empty one its place, so one odd file fails nothing."""
    names, seen = [], {FILE, PATH}
    for i, h in enumerate(next(csv.reader([header]), [])):
        name = h.strip().replace("`", "'") or (f"_c{i}" if i else "")
        k, base = 0, name
        while name.lower() in seen:
            k += 1
            name = f"{base}.{k}"
        seen.add(name.lower())
        names.append(name)
    return names if any(names) else []


def decoded(path: Column) -> Column:
    """A URL-encoded path as plain text ('+' is itself in a path)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _na_cell(name: str) -> str:
    tokens = ", ".join("'" + t + "'" for t in S.NA_TOKENS)
    return f"CASE WHEN `{name}` IN ({tokens}) THEN NULL ELSE `{name}` END AS `{name}`"


def _read_group(spark: SparkSession, names: list[str], broken: bool, files: list[str]) -> DataFrame:
    """Cells of the files of one header, with FILE and PATH."""
    if not broken:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        return (spark.read.schema(schema).option("header", True).option("escape", '"').csv([_literal_path(f) for f in files])
                .withColumn(FILE, F.col("_metadata.file_name")).withColumn(PATH, decoded(F.col("_metadata.file_path"))))
    places = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records(text_lines(spark, files)).where(~F.col("first"))
    cells = F.from_csv("record", places, {"escape": '"', "multiLine": "true"})
    path = decoded(F.col("path"))
    return rows.select(cells.alias("c"), path.alias("p")).select(
        *[F.col(f"c.c{i}").alias(n) for i, n in enumerate(names)], F.regexp_extract("p", r"([^/]+)$", 1).alias(FILE), F.col("p").alias(PATH))


def scan_csv(spark: SparkSession, folders, ext: str = ".csv", recursive: bool = True,
             na_tokens: bool = True, wanted=None) -> list[DataFrame]:
    """One all-string DataFrame per header group (plus FILE and PATH); missing values follow the usual NA tokens
    when ``na_tokens``. ``wanted``: only these columns are kept (all by default). Cells may hold
    line breaks; files are split over tasks in any case."""
    frames = []
    for header, broken, files in header_groups(spark, folders, ext, recursive):
        names = _split_header(header)
        if not names:
            continue
        df = _read_group(spark, names, broken, files)
        kept = [n for n in names if wanted is None or n in wanted]
        frames.append(df.selectExpr(*[_na_cell(n) if na_tokens else f"`{n}`" for n in kept], FILE, PATH))
    return frames


def read_new_leads(spark: SparkSession, folders, as_of, ext: str = ".csv") -> DataFrame:
    """All new lead files under ``folders`` (recursive), aligned to the lead schema;
    files without any wanted column are skipped. No usable file: no rows, same schema."""
    from ..operators.leads import empty_leads, prepare_new_leads
    frames = []
    for df in scan_csv(spark, folders, ext, wanted={*S.NEW_LEAD_HEADERS, "source_file"}):
        d = df.withColumn("source_file", F.coalesce(F.col("source_file"), F.col(FILE))) \
            if "source_file" in df.columns else df.withColumnRenamed(FILE, "source_file")
        frames.append(d.drop(FILE, PATH))
    found = prepare_new_leads(frames, as_of)
    return found if found is not None else empty_leads(spark)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History (Spanish headers, labels) -> typed canonical rows: a snapshot folder, or a folder of snapshots,
    of which the published one is read. An empty history is an error."""
    from ..operators.leads import coerce_history
    path = current(spark, path) or path
    frames = scan_csv(spark, path)
    if not frames:
        raise ValueError(f"history at {path} is empty")
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    if df.isEmpty():
        raise ValueError(f"history at {path} is empty")
    df = df.withColumn("source_file", F.lit("history")) if "source_file" not in df.columns else df
    return coerce_history(df.drop(FILE, PATH))


def read_inbox_export(spark: SparkSession, folder: str, ext: str = ".csv", recursive: bool = False) -> DataFrame:
    """Inbox export files -> typed messages. Files without ``sent_at`` are skipped;
    a file with any unparsable ``sent_at`` is skipped whole. Conversation ids are text
    (a number's trailing ``.0`` is removed, as for lead ids)."""
    msgs = None
    for df in scan_csv(spark, folder, ext, recursive=recursive):
        if "sent_at" not in df.columns:
            continue
        cols = [c for c in S.INBOX_SCHEMA.fieldNames() if c in df.columns]
        typed = df.select(
            *[(canonical_id(F.col(c)) if c == "conversation_id" else F.col(c).try_cast(S.INBOX_SCHEMA[c].dataType)).alias(c)
              for c in cols if c != "sent_at"],
            F.col("sent_at").alias("_raw_sent_at"),
            F.try_to_timestamp(strip(F.col("sent_at"))).cast("timestamp_ntz").alias("sent_at"),
            PATH,
        )
        msgs = typed if msgs is None else msgs.unionByName(typed, allowMissingColumns=True)
    if msgs is None:
        return spark.createDataFrame([], S.INBOX_SCHEMA)
    bad = F.col("_raw_sent_at").isNotNull() & F.col("sent_at").isNull()
    # One row per file with a bad timestamp: bounded by the file listing, so it is
    # broadcast (size-checked) and a huge file's rows are never shuffled to one task.
    bad_files = msgs.groupBy(PATH).agg(F.max(bad.cast("int")).alias("_bad")).where(F.col("_bad") == 1)
    good = msgs.join(bounded_broadcast(bad_files.select(PATH)), PATH, "left_anti")
    for f in S.INBOX_SCHEMA.fieldNames():
        if f not in good.columns:
            good = good.withColumn(f, F.lit(None).cast(S.INBOX_SCHEMA[f].dataType))
    return good.select(*S.INBOX_SCHEMA.fieldNames())


def executive_of(path: Column) -> Column:
    """The file's base name, or the ``executive=`` folder of files written by Spark (``part-*``)."""
    base = F.regexp_extract(path, r"([^/]+)\.[cC][sS][vV]$", 1)
    folder = F.regexp_extract(path, r"executive=([^/]+)/[^/]+$", 1)
    return F.when(base.startswith("part-") & (F.length(folder) > 0), decoded(folder)).otherwise(base)


def read_chat_export(spark: SparkSession, folder: str, ext: str = ".csv") -> DataFrame:
    """Raw chat exports: all text, no NA tokens, required columns, trimmed; the
    executive is the file's base name, or the ``executive=`` folder for files
    written by Spark (``part-*``)."""
    frames = scan_csv(spark, folder, ext, na_tokens=False)
    out = None
    for df in frames:
        missing = [c for c in ("contact", "meta", "text") if c not in df.columns]
        if missing:
            raise ValueError(f"chat export without columns {missing}: {df.columns}")
        d = df.select(*[strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("contact", "meta", "text")],
                      PATH)
        out = d if out is None else out.unionByName(d)
    if out is None:
        return spark.createDataFrame([], "executive string, contact string, meta string, text string")
    return out.select(executive_of(F.col(PATH)).alias("executive"), "contact", "meta", "text")


def read_schedule_sheet(spark: SparkSession, path: str, ext: str = ".csv") -> DataFrame:
    """Headerless weekly shift sheets -> (sheet, row_no, c0, c1, c2); the sheet is
    the file's path (files of one name in two folders stay apart) and ``row_no``
    grows with the lines of the file (offset of the split, then place in it). Cells are
    read as text; a file with fewer than three columns gets nulls."""
    schema = "c0 string, c1 string, c2 string"
    df = (spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
          .option("pathGlobFilter", _ci_glob(ext)).option("recursiveFileLookup", "true").csv(path)
          .select("c0", "c1", "c2", decoded(F.col("_metadata.file_path")).alias("_name"),
                  F.col("_metadata.file_block_start").alias("_start"))
          .withColumn("_pos", F.monotonically_increasing_id()))
    sheet = F.regexp_extract("_name", r"^(.*)\.[^.]+$", 1)
    # Inside a split monotonically_increasing_id grows with the lines (33 bits a partition);
    # the split's offset orders the splits of one file.
    per_split = 1 << 33
    row_no = F.col("_start").cast("decimal(20,0)") * F.lit(per_split).cast("decimal(11,0)") + (F.col("_pos") % F.lit(per_split))
    return df.select(sheet.alias("sheet"), row_no.cast("decimal(31,0)").alias("row_no"),
                     *[null_if_token(strip(F.col(c)), [""]).alias(c) for c in ("c0", "c1", "c2")])
