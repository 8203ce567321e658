"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key=None) -> DataFrame:
    """Spread an under-partitioned file scan over the cores before CPU-heavy row work
    (text parsing). Only when the scan's files make fewer splits than the
    cluster's default parallelism, which at scale (thousands of splits) never
    happens, so large inputs are not reshuffled. The number of splits comes from
    file sizes alone (no job, no plan execution); a stream or a frame without
    files is left as it is. Round-robin references no column, so column pruning
    still reaches the scan; Spark's sort-before-repartition makes it retry-safe."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = df._jdf.inputFiles()
    if not len(files):
        return df
    splits = max(len(files), -(-size // split))
    return df.repartition(target) if splits < target else df
