"""Whole CSV records from text lines, split over tasks.

A quoted cell may hold line breaks, so a line of a file need not be a record. Spark's
multi-line mode reads such a file in one task; here the lines of a file are
read by splits, as any text, and put together again:

1. A line changes the state "inside a quoted cell" in one of four ways (kept, flipped,
   closed, opened), found from its quotes alone. ``file_profile`` needs just this: a file in which no line of the closed state ends open has no
   broken record, and the plain reader may split it.
2. For the other files, the state before a line follows from the lines before it in its
   split (a window over one split) and the state at the split's start, which follows
   from one summary row a split.
3. A line that begins and ends closed is a record where it lies. Only lines of longer
   records are shuffled, by record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BOM = "\ufeff"


def _literal_path(path: str) -> str:
    """A path as a pattern that matches just itself."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def text_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path as Spark encodes it, block, pos, value): lines in file order by (block, pos)."""
    df = spark.read.option("lineSep", "\n").text([_literal_path(f) for f in files])
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("pos"), "value")
    return df.withColumn("value", F.when(F.startswith("value", F.lit(BOM)), F.substr("value", F.lit(2))).otherwise(F.col("value")))


def ends_open(value: Column, inside: bool) -> Column:
    """Whether a quoted cell is open after the line, if one was (not) before. Doubled quotes are text; outside, a
    quote opens a cell only where a cell begins; inside, any other quote closes."""
    marks = F.regexp_extract_all(F.concat(F.lit(","), F.replace(value, F.lit('""'), F.lit(""))), F.lit(',?"'), F.lit(0))
    state = F.aggregate(marks, F.lit(inside), lambda s, m: F.when(s, F.lit(False)).otherwise(m == ',"'))
    return F.when(F.contains(value, F.lit('"')), state).otherwise(F.lit(inside))


# Number of a line in its task, and the bits of a hash that fit beside it in a long.
_PLACE, _MARK = 1 << 33, 1 << 30


def file_profile(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, head, broken) of the files with a line: the whole first line, and whether some record goes on over a
    line break (or a cell holds a bare carriage return, which the plain reader would take for one).

    No task holds the lines that it reads: a first scan keeps two numbers a file (the place of its first line with some
    bits of that line's hash, and ``broken``), a second one the few lines of these bits, the first of which
    is the head whatever the others are."""
    value, lines = F.col("value"), text_lines(spark, files)
    mark = F.pmod(F.xxhash64(value), F.lit(_MARK))
    bare = F.contains(F.rtrim(value, F.lit("\r")), F.lit("\r"))
    rows = lines.select("path", (ends_open(value, False) | bare).alias("broken"),
                        F.when(F.col("block") == 0, F.col("pos") % _PLACE * _MARK + mark).alias("at"))
    per = rows.groupBy("path").agg(F.max("broken").alias("broken"), F.min("at").alias("at"))
    # One row a file, as in the listing that the driver has.
    marks = F.broadcast(per.select("path", "broken", (F.col("at") % _MARK).alias("mark")))
    found = lines.where(F.col("block") == 0).withColumn("mark", mark).join(marks, ["path", "mark"])
    found = found.groupBy("path", "broken", "value").agg(F.min("pos").alias("pos"))
    return found.groupBy("path").agg(F.min(F.struct("pos", "value")).alias("first"), F.max("broken").alias("broken")).select(
        "path", F.rtrim(F.col("first.value"), F.lit("\r")).alias("head"), "broken")


def _state(start: Column, constant: Column, at: Column, swaps: Column) -> Column:
    """State after ``swaps`` flips, the last setting line being ``constant`` after ``at`` of them."""
    flips = swaps - F.coalesce(at, F.lit(0))
    return F.coalesce(constant, start) != (flips % 2 == 1)


def records(lines: DataFrame) -> DataFrame:
    """(path, block, pos, first, record): the records of the files (blank lines left out); ``first`` marks a file's
    first record. Order in a file: (block, pos)."""
    value = F.col("value")
    d = lines.withColumn("f0", ends_open(value, False)).withColumn("f1", ends_open(value, True))
    d = d.withColumn("swap", (F.col("f0") & ~F.col("f1")).cast("int"))
    split = W.partitionBy("path", "block").orderBy("pos")
    before = split.rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("swaps", F.coalesce(F.sum("swap").over(before), F.lit(0)))
    d = d.withColumn("set", F.when(F.col("f0") == F.col("f1"), F.struct("pos", F.col("f0").alias("to"), F.col("swaps").alias("at"))))
    d = d.withColumn("last", F.last("set", ignorenulls=True).over(before))

    # State at the start of every split, from one row a split.
    per = d.groupBy("path", "block").agg(F.max("set").alias("set"), F.sum("swap").alias("swaps"))
    per = per.withColumn("to", F.when(F.col("set").isNotNull(), F.col("set.to") != ((F.col("swaps") - F.col("set.at")) % 2 == 1)))
    flips = F.when(F.col("to").isNull(), F.col("swaps")).otherwise(F.lit(0))
    along = W.partitionBy("path").orderBy("block")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("n", F.coalesce(F.sum(flips).over(earlier), F.lit(0)))
    per = per.withColumn("seen", F.last(F.when(F.col("to").isNotNull(), F.struct("to", F.col("n").alias("at"))), ignorenulls=True).over(earlier))
    per = per.select("path", "block", _state(F.lit(False), F.col("seen.to"), F.col("seen.at"), F.col("n")).alias("s0"))
    d = d.join(per, ["path", "block"])
    d = d.withColumn("inside", _state(F.col("s0"), F.col("last.to"), F.col("last.at"), F.col("swaps")))
    d = d.withColumn("open", F.when(F.col("inside"), F.col("f1")).otherwise(F.col("f0")))

    # Where the record of a line begins: in its split, or at the last beginning of the splits before.
    start = F.when(~F.col("inside"), F.struct("block", "pos"))
    d = d.withColumn("start", F.last(start, ignorenulls=True).over(split.rowsBetween(W.unboundedPreceding, 0)))
    ends = d.groupBy("path", "block").agg(F.max(start).alias("start"), F.min("pos").alias("low"))
    ends = ends.select("path", "block", F.last("start", ignorenulls=True).over(earlier).alias("carried"),
                       F.min(F.struct("block", "low")).over(W.partitionBy("path")).alias("origin"))
    d = d.join(ends, ["path", "block"]).withColumn("start", F.coalesce("start", "carried"))
    d = d.withColumn("first", (F.col("start.block") == F.col("origin.block")) & (F.col("start.pos") == F.col("origin.low")))

    alone = (~F.col("inside")) & ~F.col("open")
    single = d.where(alone).select("path", "start", "first", F.col("value").alias("record"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "pos", "value")))
    longer = (d.where(~alone).groupBy("path", "start").agg(F.max("first").alias("first"), pieces.alias("p"))
              .select("path", "start", "first", F.array_join("p.value", "\n").alias("record")))
    out = single.unionByName(longer).withColumn("record", F.regexp_replace("record", r"\r$", ""))
    return out.where(F.length(F.trim("record")) > 0).select("path", "start.block", "start.pos", "first", "record")
