"""Dimension tables: small user-supplied lookups (defaults are invented test values).

Every rule that was a literal dict/set/if-chain becomes a table here, so a
deployment supplies its own rows instead of editing code.
"""

from __future__ import annotations

import datetime as _dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import schema as S


def local_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Rows given in the program as a local relation: their size is known, so joins broadcast them without a job."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in kind.fields]
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


# Invented test executives used by the adapters.
TEST_EXECUTIVES = ["agent_a", "agent_b", "agent_c", "agent_d", "agent_e"]


def dim_inbox(spark: SparkSession, mapping: dict | None = None) -> DataFrame:
    """inbox_id -> executive; inboxes not listed are not processed."""
    mapping = mapping if mapping is not None else {i: e for i, e in enumerate(TEST_EXECUTIVES)}
    rows = [(int(k), str(v)) for k, v in sorted(mapping.items())]
    return local_rows(spark, rows, "inbox_id bigint, executive string")


def dim_owner(spark: SparkSession, names=None) -> DataFrame:
    """Author names that mean "the account owner" (the file's executive is added per chat)."""
    names = list(S.OWNER_WORDS if names is None else names)
    return local_rows(spark, [(n,) for n in names], "name string")


def dim_alias(spark: SparkSession, pairs=None) -> DataFrame:
    """raw name -> executive; names not listed map to themselves."""
    pairs = pairs if pairs is not None else [
        ("AGENT_A", "agent_a"),
        ("Agent B", "agent_b"),
        ("ag.c", "agent_c"),
    ]
    return local_rows(spark, [(a, b) for a, b in pairs], "raw_name string, executive string")


def dim_excluded_chat(spark: SparkSession, titles=None) -> DataFrame:
    """Chat titles never to be collected (compared after title normalisation)."""
    titles = titles if titles is not None else ["Contact 7", "  contact   14 ", "CONTACT 21", "Team Room"]
    return local_rows(spark, [(t,) for t in titles], "title string")


def dim_shift(spark: SparkSession, rows=None) -> DataFrame:
    """shift keyword -> default start/end 'HH:mm'."""
    rows = rows if rows is not None else S.SHIFT_HOURS
    return local_rows(spark, list(rows), "shift string, start string, end string")


def dim_shift_rule(spark: SparkSession, rows=None) -> DataFrame:
    """Calendar rules (see schema.SHIFT_RULE_SCHEMA). The defaults are made up for the
    tests; between them they use every shape of rule: no Sundays, a closed date,
    a closed date for one person, hours by person and date, by person and
    weekdays, by person and shift, by weekday and shift, by date and shift, a
    rule that restores the default hours, and early closing."""
    d = _dt.date
    rows = rows if rows is not None else [
        (10, None, None, 6, 6, None, "off", None, None),
        (15, None, d(1996, 5, 2), None, None, None, "off", None, None),
        (22, "agent_e", d(1998, 8, 18), None, None, None, "off", None, None),
        (23, "agent_e", d(1998, 8, 20), None, None, None, "hours", "10:20", "12:45"),
        (27, None, d(1997, 2, 7), None, None, "mañana", "hours", "06:40", "11:05"),
        (33, "agent_a", None, 2, 3, None, "hours", "07:15", "11:45"),
        (34, "agent_a", None, None, None, "tarde", "default", None, None),
        (45, None, None, 4, 4, "tarde", "hours", "15:35", "20:10"),
        (46, "agent_d", None, 0, 1, "mañana", "hours", "11:25", "19:50"),
        (0, None, d(1999, 9, 7), None, None, None, "cutoff", None, "16:20"),
        (0, None, d(1996, 11, 22), None, None, None, "cutoff", None, "11:10"),
    ]
    return local_rows(spark, rows, S.SHIFT_RULE_SCHEMA)
