"""Every registered query against its DuckDB oracle (same compare as the driver:
row count, column names, order-insensitive values) on the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as E

from .conftest import ROOT, SMOKE

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import duck, rows_of  # noqa: E402

from replylens.plans import all_oracles, all_queries  # noqa: E402

ORACLES = all_oracles()
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    a, an = rows_of(df.columns, df.collect())
    cur = con.execute(ORACLES[name])
    b, bn = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert an == bn
    assert len(a) == len(b)
    assert a == b


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "score" in df.columns


@pytest.mark.parametrize("name", ["conversation_first_response", "inbox_date_window", "scored_leads",
                                  "chat_first_response", "stream_first_response"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        df = QUERIES[name](spark, SMOKE)
        a, _ = rows_of(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    cur = con.execute(ORACLES[name])
    b, _ = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert a == b
