"""Versions of a table on shared storage, and the one that readers should see.

A writer makes a new folder and then publishes it: a small pointer file beside the folders is
replaced in one step (written beside and renamed over). Readers follow the pointer, so
they see the old version or the new one, never a half-written folder, and a run that fails
before publishing changes nothing.

``write_buckets`` / ``read_buckets`` keep a lead table in buckets by lead id: a version has folders
only for the buckets that changed and a manifest that names every bucket's folder, so a small
batch rewrites little of a large table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "_CURRENT"
VERSION = "version"
BUCKET = "bucket"
BUCKETS = 256


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, base: str, name: str) -> None:
    """Make ``<base>/<name>`` the version that readers see."""
    jvm, folder, fs = _fs(spark, base)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f"{CURRENT}-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(name.encode("utf-8")))
    finally:
        out.close()
    qualified = [fs.makeQualified(jvm.org.apache.hadoop.fs.Path(str(x))) for x in (draft, jvm.org.apache.hadoop.fs.Path(folder, CURRENT))]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified[0].toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context.rename(qualified[0], qualified[1], over)


def current(spark: SparkSession, base: str) -> str | None:
    """The published version's folder, or None when nothing was published."""
    jvm, folder, fs = _fs(spark, base)
    pointer = jvm.org.apache.hadoop.fs.Path(folder, CURRENT)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
    return f"{base.rstrip('/')}/{name}"


def folders(spark: SparkSession, base: str, prefix: str) -> list[str]:
    """Names of the folders ``<prefix>...`` below ``base``, finished or not."""
    _, folder, fs = _fs(spark, base)
    if not fs.exists(folder):
        return []
    return sorted(n for st in fs.listStatus(folder) if (n := st.getPath().getName()).startswith(prefix))


def next_version(spark: SparkSession, base: str) -> int:
    return max((int(n.split("=", 1)[1]) for n in folders(spark, base, f"{VERSION}=")), default=0) + 1


# --- a lead table in buckets

def bucket_of(lead_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(lead_id), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, base: str) -> dict[int, str] | None:
    """{bucket: folder} of the published version (None before the first); a version without rows is {}."""
    at = current(spark, base)
    if at is None:
        return None
    return {r["number"]: f"{base.rstrip('/')}/{r['folder']}" for r in spark.read.parquet(f"{at}/manifest").collect()}


def bucket_count(spark: SparkSession, base: str) -> int | None:
    at = current(spark, base)
    return spark.read.parquet(f"{at}/buckets").first()["buckets"] if at else None


def read_buckets(spark: SparkSession, base: str, only=None) -> DataFrame | None:
    """Rows of the published version, or of some of its buckets. None when it has none."""
    paths = sorted(p for b, p in (manifest(spark, base) or {}).items() if only is None or b in only)
    return spark.read.parquet(*paths) if paths else None


def write_buckets(spark: SparkSession, base: str, rows: DataFrame, key: str, buckets: int, touched=None) -> str:
    """Publish a version in which the buckets ``touched`` (all by default) hold just ``rows``; the others stay
    where they are. One task writes a bucket. Returns the version's folder."""
    name = f"{VERSION}={next_version(spark, base):09d}"
    path = f"{base.rstrip('/')}/{name}"
    out = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    out.repartition(buckets, BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{path}/data")
    kept = {} if touched is None else {b: p[len(base.rstrip("/")) + 1:] for b, p in (manifest(spark, base) or {}).items() if b not in touched}
    new = {int(n.split("=", 1)[1]): f"{name}/data/{n}" for n in folders(spark, f"{path}/data", f"{BUCKET}=")}
    places = spark.createDataFrame(sorted((kept | new).items()), "number int, folder string")
    places.coalesce(1).write.parquet(f"{path}/manifest")
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/buckets")
    publish(spark, base, name)
    return path
