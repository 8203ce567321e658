"""Incremental lead consolidation: newly arrived lead files -> a new snapshot version per micro-batch.

The file stream only reports which files arrived (the ``binaryFile`` source
with just its ``path`` column selected never reads file contents); each
micro-batch scans those files with the header-grouped CSV reader. The lead table is kept in
buckets by lead id (``sinks.snapshots``): a batch reads, merges and rewrites only the buckets its
leads fall into, and a manifest names the others where they are. The checkpoint
remembers which files were taken, so a restarted run picks up where it stopped, and reading
the previous version from storage cuts the lineage between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.leads import build_leads
from ..sinks.snapshots import BUCKETS, bucket_count, bucket_of, read_buckets, write_buckets
from ..sources.csv_scan import read_new_leads

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def merge_leads(spark: SparkSession, base: str, new: DataFrame, buckets: int | None = None) -> str | None:
    """Merge prepared new leads into the published lead table; the rows it has count as history. Only buckets with
    new leads are read and rewritten. Returns the new version's folder (None: no new lead, nothing written)."""
    buckets = buckets or bucket_count(spark, base)
    numbers = new.where(F.col("lead_id").isNotNull()).select(bucket_of(F.col("lead_id"), buckets).alias("b")).distinct()
    touched = {r["b"] for r in numbers.collect()}           # at most one number a bucket
    if not touched:
        return None
    old = read_buckets(spark, base, touched)
    history = old.drop("response_seconds").withColumn("source_rank", F.lit(0)) if old is not None else new.limit(0)
    return write_buckets(spark, base, build_leads(history, [new]), "lead_id", buckets, touched)


def consolidate_stream(spark: SparkSession, inbox: str, base: str, history: DataFrame, as_of,
                       checkpoint: str, max_files_per_trigger: int = 1_000, buckets: int = BUCKETS) -> DataFrame:
    """Run the incremental load over everything in ``inbox`` now; returns the published lead table
    (canonical scored leads).

    The first run puts the history into ``buckets`` buckets (their number stays). Versions only grow,
    whatever checkpoint a run uses; a batch never overwrites what it (or a reader) reads, and
    one that is replayed merges the same files again, which changes nothing."""
    if bucket_count(spark, base) is None:
        write_buckets(spark, base, build_leads(history, None), "lead_id", buckets)
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]").option("maxFilesPerTrigger", max_files_per_trigger)
        .load(inbox).select(F.col("path").alias("file"))
    )

    def merge(batch: DataFrame, epoch: int) -> None:
        paths = [r["file"] for r in batch.select("file").distinct().collect()]  # file names only
        if paths:
            merge_leads(spark, base, read_new_leads(spark, paths, as_of))

    q = (files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    table = read_buckets(spark, base)
    return table if table is not None else build_leads(history, None).limit(0)
