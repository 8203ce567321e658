"""CSV/parquet sinks: lead files with the user's headers, snapshots, per-executive exports."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import flag_text, safe_name, score_label, segment_label
from ..operators.joins import bounded_broadcast
from .snapshots import folders, publish


def _csv(writer, path: str) -> None:
    """All CSV sinks write what the scans read: a header, and quotes doubled inside quotes."""
    writer.option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def lead_export_frame(df: DataFrame, header: list[str] | None = None) -> DataFrame:
    """Canonical lead rows -> the user's file layout: Spanish headers, SI/NO flags,
    ISO dates, label text for score and segment, then the history's own columns.
    ``header`` (the history file's) sets the order; columns it lacks follow."""
    out = {
        "Ejecutivo": F.col("executive"),
        "ID_LEAD": F.col("lead_id"),
        "Mensaje Entrante": flag_text(F.col("has_inbound")),
        "Mensaje Saliente": flag_text(F.col("has_outbound")),
        "Fecha Entrante": F.date_format("in_date", "yyyy-MM-dd"),
        "Hora Entrante": F.col("in_time"),
        "Fecha Saliente": F.date_format("out_date", "yyyy-MM-dd"),
        "Hora Saliente": F.col("out_time"),
    }
    if "response_time" in df.columns:
        out["Tiempo Respuesta (min)"] = F.col("response_time")
    if "score" in df.columns:
        out["Score Tiempo Respuesta"] = score_label(F.col("score"))
    if "entry_segment" in df.columns:
        out["Segmento Horario Entrada"] = segment_label(F.col("entry_segment"))
    known = {f.name for f in S.LEAD_SCHEMA.fields} | {"response_seconds"}
    out |= {c: F.col(f"`{c}`") for c in df.columns if c not in known}
    order = [h for h in header or [] if h in out]
    return df.select(*[out[n].alias(n) for n in [*order, *[n for n in out if n not in order]]])


def write_lead_csv(df: DataFrame, path: str, sort: bool = True, header: list[str] | None = None) -> str:
    """Write lead rows as CSV with header (export order: executive, lead, dates, times)."""
    out = lead_export_frame(df, header)
    if sort:
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in
                            ["Ejecutivo", "ID_LEAD", "Fecha Entrante", "Hora Entrante", "Fecha Saliente", "Hora Saliente"]])
    _csv(out.write.mode("errorifexists"), path)
    return path


def write_snapshot(df: DataFrame, base: str, as_of, fmt: str = "csv") -> str:
    """Write a new snapshot folder ``<base>/snapshot=<as_of>-<run of the day>``, publish it and return it. No earlier
    snapshot is overwritten (a reader of an old one stays valid); ``read_history(base)`` reads the published one."""
    spark, day = df.sparkSession, as_of.isoformat() if isinstance(as_of, (_dt.date, _dt.datetime)) else str(as_of)
    runs = [int(n.rsplit("-", 1)[1]) for n in folders(spark, base, f"snapshot={day}-")]
    name = f"snapshot={day}-{max(runs, default=0) + 1:04d}"
    path = f"{base.rstrip('/')}/{name}"
    if fmt == "csv":
        write_lead_csv(df, path)
    else:
        df.write.mode("errorifexists").parquet(path)
    publish(spark, base, name)
    return path


EXPORT_ROWS = 1_000_000              # rows of an executive that one task writes


def write_by_executive(df: DataFrame, base: str, run_date, rows_per_file: int = EXPORT_ROWS) -> str:
    """One folder per run date and executive (K3; the folder is the per-executive
    unit). The executive column is kept in the file body too, since partition
    columns leave the body. A second run of a date replaces that date's folders, those of
    executives it no longer has included. A name that had to be cleaned for its folder carries a
    short hash, so two executives never share one. An executive's rows are dealt to as many
    tasks as ``rows_per_file`` asks for, so there are few files and no task writes a huge one."""
    day = run_date.isoformat() if isinstance(run_date, (_dt.date, _dt.datetime)) else str(run_date)
    safe = safe_name(F.col("Ejecutivo"))
    folder = F.when(safe == F.col("Ejecutivo"), safe).otherwise(
        F.concat(safe, F.lit("-"), F.substring(F.md5(F.coalesce("Ejecutivo", F.lit("")).cast("binary")), 1, 6)))
    out = lead_export_frame(df).withColumn("executive", folder)
    sizes = out.groupBy("executive").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    out = out.join(bounded_broadcast(sizes), "executive")
    out = out.withColumn("_chunk", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in out.columns]), F.col("_files")))
    out = out.repartition("executive", "_chunk").drop("_files", "_chunk")
    _csv(out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("executive"), f"{base.rstrip('/')}/run_date={day}")
    return base


def write_messages(df: DataFrame, path: str) -> bool:
    """Collected messages with the fixed header order; nothing is written when
    there are no rows. Returns whether a file set was written."""
    out = df.select("contact", "meta", "text")
    if out.isEmpty():
        return False
    _csv(out.write.mode("errorifexists"), path)
    return True
