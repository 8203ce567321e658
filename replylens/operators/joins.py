"""Join helpers: size-checked broadcast, skew-safe per-key join, and small dimension values.

Broadcast is only used behind a row-count check (a bounded ``limit().count()``
job). Above the bound the plain join is returned and Spark plans a shuffle
join; AQE can still switch it to a broadcast at run time from measured sizes.
Keys holding very many rows take a broadcast route of their own
(``join_per_key``), so no hot key's rows are shuffled into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows allowed on the broadcast side of a join.
DEFAULT_BROADCAST_ROWS = 1_000_000


# Rows given in the program itself may be broadcast up to this size (known without a job).
LOCAL_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it is known to be small, else ``df`` unchanged. Rows given
    in the program have an exact size, anything else is counted up to
    ``max_rows`` + 1 (one bounded job). Nothing is kept or persisted."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.getClass().getSimpleName() == "LocalRelation":
        return F.broadcast(df) if int(str(plan.stats().sizeInBytes())) <= LOCAL_BROADCAST_BYTES else df
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


# A key with more rows than this is "hot": its partner row is broadcast instead
# of shuffling its rows to one task. More than MAX_HOT_KEYS hot keys are too many
# to broadcast; then every key is spread over SALTS tasks.
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
SALTS = 32
HOT_KEY_CONF = "replylens.skew.hotKeyRows"


def hot_threshold(spark, hot_rows: int | None = None) -> int:
    """Explicit value, else the session setting ``replylens.skew.hotKeyRows``, else the default."""
    if hot_rows is not None:
        return int(hot_rows)
    return int(spark.conf.get(HOT_KEY_CONF, str(HOT_KEY_ROWS)))


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None,
             max_keys: int = MAX_HOT_KEYS) -> DataFrame | str | None:
    """Keys holding more than ``hot_rows`` rows, as a small DataFrame (None: there is
    none; "many": more than ``max_keys``). One partially aggregated count; the
    bounded key list is fixed once, so a retried stage sees the same set."""
    limit = hot_threshold(df.sparkSession, hot_rows)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    rows = counts.select(*keys).limit(max_keys + 1).collect()
    if not rows:
        return None
    if len(rows) > max_keys:
        return "many"
    return df.sparkSession.createDataFrame(rows, df.select(*keys).schema)


def join_per_key(big: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner",
                 hot_rows: int | None = None, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Join ``big`` with ``per_key`` (at most one row per key) without sending a hot
    key's rows to one task: hot keys meet their broadcast partner rows where
    they are (no shuffle of their rows), other keys use the ordinary shuffle
    join. With too many hot keys to broadcast, every partner row is repeated for
    SALTS tasks. All routes are exact; the hot set only chooses the route."""
    hot = hot_keys(big, keys, hot_rows, max_keys)
    if hot is None:
        return big.join(per_key, keys, how)
    if isinstance(hot, str):
        salted = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)))
        copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
    hot_b = F.broadcast(hot)
    partners = per_key.join(hot_b, keys, "left_semi")       # one row per hot key, if the caller keeps its word
    hot_part = big.join(hot_b, keys, "left_semi").join(bounded_broadcast(partners, max_keys), keys, how)
    cold_part = big.join(hot_b, keys, "left_anti").join(per_key.join(hot_b, keys, "left_anti"), keys, how)
    return hot_part.unionByName(cold_part)


def small_values(df: DataFrame, col: str, max_rows: int = 10_000) -> list | None:
    """Distinct values of a small dimension column as a Python list (for an
    ``isin`` test kept inside the scan stage), or None when the dimension
    has more than ``max_rows`` values (callers then join)."""
    vals = [r[0] for r in df.select(col).distinct().limit(max_rows + 1).collect()]
    return sorted(v for v in vals if v is not None) if len(vals) <= max_rows else None
