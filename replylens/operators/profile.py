"""Profiles, previews, slices and KPI rollups over lead tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import strip

UNMATCHED = "unmatched"


def _pattern_label(c):
    expr = None
    for name, pat in S.DATE_PATTERNS:
        expr = F.when(c.rlike(pat), F.lit(name)) if expr is None else expr.when(c.rlike(pat), F.lit(name))
    return expr.otherwise(F.lit(UNMATCHED))


def date_format_profile(df: DataFrame, col: str) -> DataFrame:
    """Non-null values of a date-text column counted per known pattern, the
    unmatched count, and the total (``pattern`` null). One aggregate pass."""
    s = strip(F.col(col).cast("string"))
    return (
        df.where(F.col(col).isNotNull())
        .select(_pattern_label(s).alias("pattern"))
        .rollup("pattern")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def odd_date_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """First ``n`` distinct values (sorted) matching none of the known patterns."""
    s = strip(F.col(col).cast("string"))
    return (
        df.where(F.col(col).isNotNull())
        .select(s.alias("value"))
        .where(_pattern_label(F.col("value")) == UNMATCHED)
        .distinct()
        .orderBy("value")
        .limit(n)
    )


def date_bounds(df: DataFrame) -> DataFrame:
    """Latest inbound and outbound date (nulls ignored)."""
    return df.agg(F.max("in_date").alias("max_in_date"), F.max("out_date").alias("max_out_date"))


def latest(df: DataFrame, by: str = "in_date", n: int = 40) -> DataFrame:
    """Newest ``n`` rows by a date column (missing last, lead id breaks ties)."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col("lead_id"), F.col("executive")).limit(n)


def lead_lookup(df: DataFrame, lead_id) -> DataFrame:
    return df.where(F.col("lead_id") == F.lit(str(lead_id)))


def executive_date_slice(df: DataFrame, executive: str, start, end) -> DataFrame:
    """One executive's leads with inbound date in [start, end] (inclusive)."""
    return df.where((F.col("executive") == executive)
                    & F.col("in_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def date_slice(df: DataFrame, start, end) -> DataFrame:
    return df.where((F.col("in_date") >= F.lit(start).cast("date")) & (F.col("in_date") <= F.lit(end).cast("date")))


def distinct_executives(df: DataFrame) -> DataFrame:
    return df.select("executive").distinct()


def kpi_score_rollup(df: DataFrame) -> DataFrame:
    """Leads per (executive, score) with executive subtotals and a grand total."""
    return df.rollup("executive", "score").agg(
        F.count(F.lit(1)).alias("leads"),
        F.grouping_id().cast("bigint").alias("level"),
    )


def kpi_response_stats(df: DataFrame) -> DataFrame:
    """Per executive and entry segment: leads, answered share and response-time
    statistics in seconds. Rows are first counted per (group, second), where
    every task adds up its own, so a large group reaches its exact weighted
    percentile as one row per distinct second."""
    secs, n = F.col("response_seconds").cast("double"), F.col("_n")
    seconds = df.groupBy("executive", "entry_segment", "response_seconds").agg(F.count(F.lit(1)).alias("_n"))
    answered = F.sum(F.when(F.col("response_seconds").isNotNull(), n).otherwise(0))
    return seconds.groupBy("executive", "entry_segment").agg(
        F.sum(n).alias("leads"),
        F.round(answered / F.sum(n), 6).alias("answered_share"),
        F.round(F.try_divide(F.sum(secs * n), answered), 3).alias("avg_seconds"),
        F.round(F.percentile(secs, 0.5, n), 3).alias("median_seconds"),
        F.round(F.percentile(secs, 0.9, n), 3).alias("p90_seconds"),
    )
