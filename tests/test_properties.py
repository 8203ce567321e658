"""Properties over the provided tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from replylens.functions import seconds_to_hms
from replylens.operators.leads import build_leads

from .conftest import SMALL

Q = E.queries()


def test_in_and_off_shift_partition_the_leads(spark):
    leads = Q["scored_leads"](spark, SMALL).select("lead_id")
    inside = Q["in_shift_leads"](spark, SMALL).select("lead_id")
    outside = Q["off_shift_leads"](spark, SMALL).select("lead_id")
    assert inside.intersect(outside).count() == 0
    assert inside.count() + outside.count() == leads.count()
    assert inside.unionByName(outside).exceptAll(leads).count() == 0


def test_dedupe_output_is_unique_and_responses_are_consistent(spark):
    df = Q["scored_leads"](spark, SMALL)
    assert df.count() == df.select("lead_id").distinct().count()
    assert df.where(F.col("response_seconds") < 0).count() == 0
    # response_time text and response_seconds agree wherever a response exists
    bad = df.where(F.col("response_seconds").isNotNull()
                   & (seconds_to_hms(F.col("response_seconds")) != F.col("response_time")))
    assert bad.count() == 0
    # every row has a segment; a score exists whenever an inbound date and time exist
    assert df.where(F.col("entry_segment").isNull()).count() == 0
    assert df.where(F.col("in_date").isNotNull() & F.col("in_time").isNotNull() & F.col("score").isNull()).count() == 0


def test_consolidation_is_idempotent(spark):
    once = Q["scored_leads"](spark, SMALL).drop("response_seconds")
    twice = build_leads(once, None).drop("response_seconds")
    cols = once.columns
    assert once.select(*cols).exceptAll(twice.select(*cols)).count() == 0
    assert twice.select(*cols).exceptAll(once.select(*cols)).count() == 0
