"""Registry of named queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


_MEMO: dict[tuple, DataFrame] = {}


def shared(fn):
    """Memoize a lazy plan builder per (session, data dir): derived queries reuse
    one DataFrame object instead of rebuilding the same plan (and re-running
    its broadcast size checks). Only for builders that write nothing."""
    def wrapper(spark: SparkSession, sf: str) -> DataFrame:
        key = (fn.__module__, fn.__name__, id(spark), spark.sparkContext.applicationId, sf)
        if key not in _MEMO:
            _MEMO[key] = fn(spark, sf)
        return _MEMO[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def forget() -> None:
    """Drop the memoized plans (plans only; no data is kept)."""
    _MEMO.clear()
