"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A word is a run of anything but the six ASCII white-space characters.
WORD_RUN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)).cast("long"), F.lit(0).cast("long"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n).cast("long"))


def held_out(doc_id: Column, n: int, remainder: int) -> Column:
    """True where the fold is never learned from; a null id is never learned from."""
    return F.coalesce(fold(doc_id, n) == remainder, F.lit(True))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage so that a lost
    executor costs a re-read, and a plan used several times is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_ids(df: DataFrame, key: str, rows: int, seed: str) -> DataFrame:
    """At most ``rows`` distinct non-null keys, chosen by seeded hash: the documented
    bound of a training sample. Depends on the key values only."""
    return (df.select(key).where(F.col(key).isNotNull()).distinct()
            .orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(rows))


def ranked(df: DataFrame, group: list[str], order: list[Column], block: Column, out: str) -> DataFrame:
    """Exact 0-based position of every row inside its group, without sorting a group in
    one task: rows are numbered inside (group, block) and shifted by the number
    of rows in the group's earlier blocks. ``block`` must split hot groups
    (for example a hash of the id) and be non-null; ties in ``order`` take any order."""
    from pyspark.sql import Window as W
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_block").alias("_b"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_offset"))
    inside = F.row_number().over(W.partitionBy(*group, "_block").orderBy(*order)).cast("long") - 1
    on = F.col("_block") == F.col("_b")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    numbered = rows.withColumn("_inside", inside)
    return (numbered.join(offsets, on, "inner").withColumn(out, F.col("_offset") + F.col("_inside"))
            .select(*df.columns, out))
