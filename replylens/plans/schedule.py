"""Queries over the working calendar and the leads inside / outside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..dims import dim_alias, dim_shift, dim_shift_rule
from ..functions import classify_shift
from ..operators import schedule as SC
from ..session import scratch_path
from ..sources.adapters import lead_facts, read_table, schedule_sheet
from ..sources.csv_scan import read_schedule_sheet
from .leads import scored_leads
from .registry import query, shared


@shared
def sheet(spark, sf):
    facts = lead_facts(read_table(spark, sf, "orders"))
    return schedule_sheet(facts.select(F.to_date("in_ts").alias("in_date")))


WEEKS_PER_FILE = 13


def sheet_files(spark, sf):
    """The sheet as headerless CSV files, a quarter in each, read back as sheets."""
    path = scratch_path(spark, "sheets")
    rows = sheet(spark, sf).withColumn("quarter", F.floor(F.col("row_no") / (10 * WEEKS_PER_FILE)))
    rows = rows.repartition("quarter").sortWithinPartitions("quarter", "row_no")
    rows.select("quarter", "c0", "c1", "c2").write.partitionBy("quarter").option("escape", '"').csv(path)
    return read_schedule_sheet(spark, path)


def sunday_rule(spark):
    rules = dim_shift_rule(spark)
    return rules.where((F.col("priority") == 10))


@shared
def full_schedule(spark, sf):
    return SC.expand_schedule(sheet(spark, sf), dim_shift_rule(spark), dim_shift(spark), dim_alias(spark))


@shared
def windows(spark, sf):
    return SC.shift_windows(full_schedule(spark, sf))


def calendar(spark, sf):
    return SC.stored_windows(windows(spark, sf))


@query("classify_shift")
def q_classify_shift(spark, sf):
    s = sheet(spark, sf)
    return s.where(F.col("c2").isNotNull()).select("row_no", "c2", classify_shift(F.col("c2")).alias("shift"))


@query("schedule_expand")
def q_schedule_expand(spark, sf):
    return SC.sorted_schedule(SC.expand_schedule(sheet_files(spark, sf), sunday_rule(spark), dim_shift(spark),
                                                 dim_alias(spark)))


@query("schedule_rules")
def q_schedule_rules(spark, sf):
    return SC.sorted_schedule(full_schedule(spark, sf))


@query("shift_windows")
def q_shift_windows(spark, sf):
    return windows(spark, sf)


@query("shift_join")
def q_shift_join(spark, sf):
    leads = scored_leads(spark, sf).select("executive", "lead_id", "in_date", "in_time")
    return SC.shift_join(leads, calendar(spark, sf))


@query("in_shift_leads")
def q_in_shift_leads(spark, sf):
    return SC.in_shift(scored_leads(spark, sf), calendar(spark, sf), dim_alias(spark))


@query("off_shift_leads")
def q_off_shift_leads(spark, sf):
    return SC.off_shift(scored_leads(spark, sf), calendar(spark, sf), dim_alias(spark))
