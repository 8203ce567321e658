"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

1. Targets: the sources, by code point with null last, weigh 1, 2, 3, 1, ... and
   share all words; a target stops at ``max_repeats`` times the source's size and
   the excess goes to the others by weight (closed form over the sorted caps).
2. The words are cut into equal blocks of ``block_words``. Blocks go to sources by
   the highest quotients target / (2k + 1). Only quotients near the fair quota are
   listed; the earlier ones are certain, so the work grows with the number of
   sources, not of blocks.
3. A source's quota goes to its shards (hash of the id) by the same rule over
   shard sizes.
4. In a shard the documents lie on a line in seeded order, cut into blocks; full
   passes take every block and the rest of the quota takes evenly spaced blocks
   from a seeded phase. A document's taken words are its overlap with them.

A hot source is spread over the shards; no window spans more than one shard
(about ``shard_rows`` rows over all sources) except those over the list of
sources. Defined cases: null text has size 0; a null source is a source of its
own; size 0 takes 0; rows without an id are placed by their texts; repeated ids share a place on the line in any order of
equals; an empty table gives an empty mix; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD_RUN, materialize, word_count

BLOCK_WORDS = 64
SHARD_ROWS = 100_000
MAX_REPEATS = 3
SEED = "mix-1"


def seeded_key(seed: str, key: Column) -> Column:
    """Seeded order key as hex text (md5, so that plain SQL can repeat it)."""
    return F.md5(F.concat(F.lit(seed + ":"), key.cast("string")).cast("binary"))


def _text_name() -> Column:
    """Stands for the id of a row without one."""
    return F.concat(F.lit("null-"), F.coalesce(F.xxhash64("text").cast("string"), F.lit("")))


def _source_key(src: Column) -> Column:
    """Sorts by code point (UTF-8 bytes), null last, and is never null."""
    return F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src))


def target_sizes(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(skey, source_size) -> + target. The list of sources is small, so plain windows over it."""
    by_key = W.partitionBy(F.lit(0)).orderBy("skey")
    caps = (sources.withColumn("weight", (F.row_number().over(by_key) - 1) % 3 + 1)
            .withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
            .withColumn("level", F.col("cap") / F.col("weight")))
    everything = W.partitionBy(F.lit(0))
    below = W.partitionBy(F.lit(0)).orderBy("level", "skey").rowsBetween(W.unboundedPreceding, -1)
    # theta: words per unit of weight if every source with a lower level stands at its cap.
    caps = (caps.withColumn("total", F.sum("source_size").over(everything).cast("double"))
            .withColumn("weights", F.sum("weight").over(everything).cast("double"))
            .withColumn("theta", (F.col("total") - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
                        / (F.col("weights") - F.coalesce(F.sum("weight").over(below), F.lit(0)))))
    # The first source (lowest level) not reached by its theta fixes the level of all uncapped ones.
    level = F.min(F.when(F.col("level") >= F.col("theta"), F.struct("level", "skey", "theta"))).over(everything)["theta"]
    return (caps.withColumn("share", level)
            .withColumn("target", F.when(F.col("share").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("share"))))
            .select("skey", "source_size", "target"))


def apportion(parties: DataFrame, group: list[str], key: str, votes: str, seats: Column, out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` (one value per group) go to the parties by highest
    quotient votes / (2k + 1), ties to the smaller key. The final number of a
    party differs from its rounded fair share by less than c = parties * share + 2,
    so its first (fair - c) seats are certain and only 2c quotients are ranked:
    about 6 rows per party in all."""
    g = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    p = (parties.withColumn("_seats", seats.cast("long"))
         .withColumn("_all", F.sum(F.col(votes)).over(g)).withColumn("_m", F.count(F.lit(1)).over(g))
         .withColumn("_share", F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0)))
         .withColumn("_fair", F.floor(F.col("_share") * F.col("_seats") + F.lit(0.5)).cast("long"))
         .withColumn("_c", F.ceil(F.col("_share") * F.col("_m")).cast("long") + 2)
         .withColumn("_sure", F.greatest(F.lit(0).cast("long"), F.col("_fair") - F.col("_c"))))
    p = p.withColumn("_open", F.col("_seats") - F.sum("_sure").over(g))
    keys = [*group, key]
    order = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    won = (p.where(F.col(votes) > 0)
           .select(*keys, F.col(votes).alias("_v"), "_open", F.explode(F.sequence("_sure", F.col("_fair") + F.col("_c"))).alias("_k"))
           .withColumn("_r", F.row_number().over(order.orderBy((F.col("_v") / (2 * F.col("_k") + 1)).desc(), key, "_k")))
           .where(F.col("_r") <= F.col("_open"))
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("_won")))
    return (p.join(won, keys, "left")
            .withColumn(out, F.when(F.col(votes) > 0, F.col("_sure") + F.coalesce(F.col("_won"), F.lit(0).cast("long")))
                        .otherwise(F.lit(0).cast("long")))
            .select(*parties.columns, out))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and where it lies: passes
    (whole takes), and the list ``parts`` of (first word, words) taken once more."""
    b = F.lit(block_words).cast("long")
    name = F.when(F.col("doc_id").isNull(), _text_name()).alias("name")
    sizes = materialize(docs.select("doc_id", name, _source_key(F.col("source")).alias("skey"), word_count(F.col("text")).alias("size")),
                        "mix-sizes")
    n_shards = max(1, -(-sizes.count() // shard_rows))
    placed = (sizes.withColumn("order_key", seeded_key(seed, F.coalesce(F.col("doc_id").cast("string"), "name")))
              .withColumn("shard", F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") % n_shards))
    shards = placed.groupBy("skey", "shard").agg(F.sum("size").alias("shard_size"))
    sources = target_sizes(shards.groupBy("skey").agg(F.sum("shard_size").alias("source_size")), max_repeats)
    total = W.partitionBy(F.lit(0))
    quotas = apportion(sources.withColumn("blocks", F.round(F.sum("source_size").over(total) / b).cast("long")),
                       [], "skey", "target", F.col("blocks"), "quota")
    per_shard = shards.join(quotas.select("skey", "source_size", "target", "quota"), "skey")
    per_shard = apportion(per_shard, ["skey"], "shard", "shard_size", F.col("quota"), "shard_quota")
    # nb blocks on the line; passes take all of them, `extra` are taken once more.
    nb = F.ceil(F.col("shard_size") / b).cast("long")
    per_shard = (per_shard.withColumn("nb", nb)
                 .withColumn("q", F.least(F.col("shard_quota"), F.col("nb") * max_repeats))
                 .withColumn("passes", F.when(F.col("nb") > 0, F.floor(F.col("q") / F.col("nb"))).otherwise(0).cast("long"))
                 .withColumn("extra", F.when(F.col("nb") > 0, F.col("q") % F.col("nb")).otherwise(0).cast("long"))
                 .withColumn("phase", F.when(F.col("nb") > 0, F.conv(F.substring(seeded_key(
                     seed, F.concat(F.col("skey"), F.lit("/"), F.col("shard").cast("string"))), 1, 8), 16, 10).cast("long")
                     % F.col("nb")).otherwise(0).cast("long"))
                 .select("skey", "shard", "source_size", "target", "nb", "passes", "extra", "phase"))
    per_shard = materialize(per_shard, "mix-quotas")
    line = W.partitionBy("skey", "shard").orderBy("order_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    laid = placed.withColumn("stop", F.sum("size").over(line)).withColumn("start", F.col("stop") - F.col("size"))
    joined = laid.join(per_shard, ["skey", "shard"], "inner")
    first, last = F.floor(F.col("start") / b), F.floor((F.col("stop") - 1) / b)
    blocks = F.when((F.col("size") > 0) & (F.col("extra") > 0), F.sequence(first.cast("long"), last.cast("long"))).otherwise(
        F.array().cast("array<bigint>"))
    chosen = F.filter(blocks, lambda i: F.pmod(i * F.col("extra") + F.col("phase"), F.col("nb"))
                      >= F.col("nb") - F.col("extra"))
    parts = F.transform(chosen, lambda i: F.struct(
        (F.greatest(i * b, F.col("start")) - F.col("start")).alias("first"),
        (F.least((i + 1) * b, F.col("stop")) - F.greatest(i * b, F.col("start"))).alias("words")))
    got = joined.withColumn("parts", parts)
    once = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: acc + x["words"])
    return got.select("doc_id", "size", "source_size", "target",
                      (F.col("passes") * F.col("size") + once).alias("taken"), "passes", "parts")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a document is repeated once per whole pass and, where
    blocks are taken once more, once with just those words (joined by one space
    unless the text is taken whole). Documents of no words are not in a mix. Rows
    without an id are told apart by their texts, so they are no group of their own."""
    key = F.coalesce(F.col("doc_id").cast("string"), _text_name()).alias("id")
    plan = mix(docs.withColumn("doc_id", key), **options)
    plan = (plan.select(F.col("doc_id").alias("id"), F.col("size").alias("words"), F.struct("taken", "passes", "parts").alias("take"))
            .groupBy("id", "words").agg(F.sort_array(F.collect_list("take")).alias("takes")))
    # The whole row travels as one column, so no column of the documents can clash.
    rows = docs.select(key, word_count(F.col("text")).alias("words"), F.struct("*").alias("doc")).where("words > 0")
    rows = rows.join(plan, ["id", "words"], "inner")
    # Rows of one id and size are numbered where the join put them, so each gets a take of its own.
    nth = F.row_number().over(W.partitionBy("id", "words").orderBy(F.xxhash64("doc.text", "doc.source")))
    rows = rows.withColumn("take", F.get("takes", nth - 1)).where("take.taken > 0")
    text = F.col("doc.text")
    words = F.regexp_extract_all(text, F.lit("(" + WORD_RUN + ")"), F.lit(1))
    rest = F.col("take.taken") - F.col("take.passes") * F.col("words")
    # The words are bound once; written into the inner function, they would be split again for every part.
    cut = F.get(F.transform(F.array(words), lambda all_: F.array_join(F.flatten(F.transform(
        "take.parts", lambda p: F.slice(all_, (p["first"] + 1).cast("int"), p["words"].cast("int")))), " ")), F.lit(0))
    extra = F.when(rest == 0, F.array().cast("array<string>")).when(rest == F.col("words"), F.array(text)).otherwise(F.array(cut))
    copies = F.concat(F.array_repeat(text, F.col("take.passes").cast("int")), extra)
    out = rows.select("doc", F.explode(copies).alias("new"))
    kept = [F.col("new").alias(c) if c == "text" else F.length("new").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return out.select(*kept)
