"""Queries over lead files: align, consolidate, normalise, dedupe, score, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import dim_alias
from ..functions import normalize_date, normalize_time, null_if_token
from ..operators import leads as L
from ..operators import profile as P
from ..sources.adapters import AS_OF, lead_files, lead_table, read_table
from .registry import query, shared

# Column subsets of the three new-file layouts (one lacks ID_LEAD, one lacks the reply).
NEW_FILE_LAYOUTS = {
    "new_0.csv": ["Ejecutivo", "ID_LEAD", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante",
                  "Hora Entrante", "Fecha Saliente", "Hora Saliente", "source_file", "o_extra"],
    "new_1.csv": ["Ejecutivo", "lead_id", "Mensaje Entrante", "Mensaje Saliente", "Fecha Entrante",
                  "Hora Entrante", "Fecha Saliente", "Hora Saliente", "source_file"],
    "new_2.csv": ["Hora Entrante", "Ejecutivo", "ID_LEAD", "Fecha Entrante", "Mensaje Entrante",
                  "Mensaje Saliente", "source_file"],
}


@shared
def _styled_files(spark, sf):
    return lead_files(read_table(spark, sf, "orders"), True)


def files(spark, sf, styled=True):
    return _styled_files(spark, sf) if styled else lead_files(read_table(spark, sf, "orders"), False)


def new_file_frames(new):
    """The new rows split into three files of different layouts."""
    out = []
    for name, cols in NEW_FILE_LAYOUTS.items():
        f = new.where(F.col("source_file") == name).withColumn("o_extra", F.lit("x"))
        if "lead_id" in cols:
            f = f.withColumnRenamed("ID_LEAD", "lead_id")
        out.append(f.select(*cols))
    return out


def history_table(spark, sf):
    history, _ = files(spark, sf)
    return L.coerce_history(history)


def consolidated(spark, sf):
    history, new = files(spark, sf)
    base = L.coerce_history(history)
    return L.consolidate(base, L.prepare_new_leads(new_file_frames(new), AS_OF))


@shared
def scored_leads(spark, sf):
    history, new = files(spark, sf)
    prepared = L.prepare_new_leads(new_file_frames(new), AS_OF)
    return L.build_leads(L.coerce_history(history), prepared)


@shared
def typed_leads(spark, sf):
    return lead_table(read_table(spark, sf, "orders"))


@query("align_schema")
def q_align_schema(spark, sf):
    _, new = files(spark, sf)
    return L.prepare_new_leads(new_file_frames(new), AS_OF)


@query("coerce_history")
def q_coerce_history(spark, sf):
    return history_table(spark, sf)


@query("consolidate_history")
def q_consolidate_history(spark, sf):
    df = consolidated(spark, sf)
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in
                        ["executive", "lead_id", "in_date", "in_time", "out_date", "out_time"]])


@query("normalize_dates")
def q_normalize_dates(spark, sf):
    _, new = files(spark, sf)
    return new.select(F.col("ID_LEAD").alias("lead_id"), F.col("Fecha Entrante").alias("raw"),
                      normalize_date(F.col("Fecha Entrante"), AS_OF).alias("in_date"))


@query("normalize_dates_strict")
def q_normalize_dates_strict(spark, sf):
    _, new = files(spark, sf)
    return new.select(F.col("ID_LEAD").alias("lead_id"), F.col("Fecha Entrante").alias("raw"),
                      normalize_date(F.col("Fecha Entrante"), strict=True).alias("in_date"))


@query("normalize_times")
def q_normalize_times(spark, sf):
    _, new = files(spark, sf)
    return new.select(F.col("ID_LEAD").alias("lead_id"), F.col("Hora Entrante").alias("raw"),
                      normalize_time(F.col("Hora Entrante")).alias("in_time"))


@query("null_tokens")
def q_null_tokens(spark, sf):
    _, new = files(spark, sf)
    cols = ["ID_LEAD", "Fecha Entrante", "Hora Entrante", "Fecha Saliente", "Hora Saliente"]
    return new.select(*[null_if_token(F.col(c)).alias(c.lower().replace(" ", "_")) for c in cols])


@query("dedupe_leads")
def q_dedupe_leads(spark, sf):
    return L.dedupe_leads(L.normalize_lead_times(consolidated(spark, sf)))


@query("response_time")
def q_response_time(spark, sf):
    out = L.with_response_time(typed_leads(spark, sf))
    return out.select("source_file", "lead_id", "in_date", "in_time", "out_date", "out_time", "response_time")


@query("score")
def q_score(spark, sf):
    out = L.with_score(L.with_response_time(typed_leads(spark, sf)))
    return out.select("source_file", "lead_id", "response_time", "score")


@query("entry_segment")
def q_entry_segment(spark, sf):
    out = L.with_entry_segment(typed_leads(spark, sf))
    return out.select("source_file", "lead_id", "in_time", "entry_segment")


@query("scored_leads")
def q_scored_leads(spark, sf):
    return scored_leads(spark, sf)


@query("aliased_leads")
def q_aliased_leads(spark, sf):
    """The run over files in which two executives appear under other names: they get one name before the dedupe."""
    def renamed(df):
        e, odd = F.col("Ejecutivo"), F.length("ID_LEAD" if "ID_LEAD" in df.columns else "lead_id") % 2 == 0
        return df.withColumn("Ejecutivo", F.when(odd & (e == "agent_a"), "AGENT_A").when(odd & (e == "agent_b"), "Agent B").otherwise(e))
    history, new = files(spark, sf)
    prepared = L.prepare_new_leads([renamed(f) for f in new_file_frames(new)], AS_OF)
    return L.build_leads(L.coerce_history(renamed(history)), prepared, aliases=dim_alias(spark))


@query("map_executive")
def q_map_executive(spark, sf):
    t = typed_leads(spark, sf)
    raw = t.withColumn("executive", F.when(F.col("source_file").endswith("0"), F.upper("executive"))
                       .otherwise(F.col("executive")))
    return L.map_executive(raw, dim_alias(spark)).select("source_file", "executive")


@query("date_format_profile")
def q_date_format_profile(spark, sf):
    _, new = files(spark, sf)
    return P.date_format_profile(new, "Fecha Entrante")


@query("date_format_odd_values")
def q_date_format_odd_values(spark, sf):
    _, new = files(spark, sf)
    return P.odd_date_values(new, "Fecha Entrante", 20)


@query("date_bounds")
def q_date_bounds(spark, sf):
    return P.date_bounds(scored_leads(spark, sf))


@query("latest_leads")
def q_latest_leads(spark, sf):
    return P.latest(scored_leads(spark, sf), "in_date", 40)


@query("latest_replies")
def q_latest_replies(spark, sf):
    return P.latest(scored_leads(spark, sf), "out_date", 40)


@query("lead_lookup")
def q_lead_lookup(spark, sf):
    return P.lead_lookup(scored_leads(spark, sf), "10")


@query("executive_date_slice")
def q_executive_date_slice(spark, sf):
    return P.executive_date_slice(scored_leads(spark, sf), "agent_b", "1998-01-01", "1998-03-31")


@query("date_slice")
def q_date_slice(spark, sf):
    return P.date_slice(scored_leads(spark, sf), "1999-01-01", "1999-01-31")


@query("distinct_executives")
def q_distinct_executives(spark, sf):
    return P.distinct_executives(scored_leads(spark, sf))


@query("kpi_score_rollup")
def q_kpi_score_rollup(spark, sf):
    return P.kpi_score_rollup(scored_leads(spark, sf))


@query("kpi_response_stats")
def q_kpi_response_stats(spark, sf):
    return P.kpi_response_stats(scored_leads(spark, sf))
