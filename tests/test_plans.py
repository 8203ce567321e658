"""Plan shape at scale: shuffles, no Python evaluation, pruned scans, no global windows."""

import pytest

import __spark_entry__ as E

from .conftest import SMOKE


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def operator_shuffles(plan):
    """Hash exchanges Spark inserts for joins/aggregates (not the local input spread)."""
    return sum(1 for line in plan.splitlines()
               if "Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line)


@pytest.fixture(scope="module")
def queries():
    return E.queries()


@pytest.mark.parametrize("name", ["scored_leads", "chat_first_response", "inbox_first_response", "dedupe_leads",
                                  "in_shift_leads", "kpi_response_stats", "message_dedupe"])
def test_no_python_and_no_global_window(spark, queries, name):
    plan = plan_of(queries[name](spark, SMOKE))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan
    assert "Exchange SinglePartition" not in plan


def test_dedupe_is_one_hash_shuffle(spark, queries):
    plan = plan_of(queries["dedupe_leads"](spark, SMOKE))
    assert operator_shuffles(plan) == 1
    assert "Window" not in plan            # partial aggregation, not a ranked window


def test_chat_first_response_reads_messages_once(spark, queries):
    plan = plan_of(queries["chat_first_response"](spark, SMOKE))
    assert plan.count("FileScan parquet") == 1           # raw messages parsed once
    assert operator_shuffles(plan) == 2                  # per-minute aggregate, then per chat
    assert "partial_max" in plan                         # map-side combine before the shuffle


@pytest.mark.parametrize("name", ["inbox_first_response", "inbox_first_response_strict", "inbox_date_window"])
def test_inbox_reads_messages_once(spark, queries, name):
    plan = plan_of(queries[name](spark, SMOKE))
    assert plan.count("FileScan parquet") == 1
    assert operator_shuffles(plan) == 2                  # two earliest rows of each kind, then per conversation
    before = plan[plan.index("Exchange hashpartitioning(conversation_id", plan.index("Exchange hashpartitioning(conversation_id") + 1):]
    assert "WindowGroupLimit" in before                  # limited before its shuffle


def test_scan_prunes_columns(spark, queries):
    plan = queries["inbox_first_response"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_in_shift_is_a_broadcast_semi_join(spark, queries):
    plan = plan_of(queries["in_shift_leads"](spark, SMOKE))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
