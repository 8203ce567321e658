"""Named queries (one per operator family) and their DuckDB oracles."""

from __future__ import annotations


def all_queries():
    from . import leads, messages, schedule, sinks, streams  # noqa: F401  (register)
    from .registry import QUERIES
    return dict(QUERIES)


def all_oracles():
    from . import oracle, oracle_leads  # noqa: F401
    from .oracle import ORACLE
    queries = all_queries()
    return {k: v for k, v in ORACLE.items() if k in queries}
