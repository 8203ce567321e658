"""Packing by optimal length buckets.

The global histogram of lengths (one row per distinct length; a corpus of T
words has fewer than sqrt(2T) distinct lengths, so it fits the driver) goes
through a dynamic programme that places the bucket boundaries with the least
total padding. Inside a bucket every row is padded to the bucket's length, so
a batch holds floor(budget / bucket length) rows, at least one, in seeded order.

Defined cases: null and empty texts have length 0 and form a bucket of length 0
(batches of ``token_budget`` rows); a text longer than the budget is a batch of
its own; repeated ids are packed as rows; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ranked, word_count

BUCKETS = 16
TOKEN_BUDGET = 16_384
BLOCK_ROWS = 50_000
SEED = "pack-1"


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends (ascending, the last is the longest length) of at most ``buckets``
    buckets with the least total padding.

    With N rows up to a boundary, best[j] = min over i < j of best[i] + L_j * (N_j - N_i):
    for every j a minimum over lines with falling slopes -N_i at the rising
    points L_j, so one pass with a lower hull fills a layer in linear time."""
    order = np.argsort(lengths)
    ends, n = [int(x) for x in lengths[order]], [0, *np.cumsum(counts[order]).tolist()]
    if not ends:
        return []
    size = len(ends)
    best, back = [0] + [None] * size, []
    for _ in range(min(buckets, size)):
        new, came = [None] * (size + 1), [0] * (size + 1)
        hull, at = [], 0                               # indices i; the line of i is best[i] - N_i * x
        for j in range(1, size + 1):
            i = j - 1
            if best[i] is not None:
                while len(hull) - at >= 2:
                    a, b = hull[-2], hull[-1]          # drop b when i overtakes it before b overtakes a
                    if (best[i] - best[a]) * (n[b] - n[a]) <= (best[b] - best[a]) * (n[i] - n[a]):
                        hull.pop()
                    else:
                        break
                hull.append(i)
            x = ends[j - 1]
            while len(hull) - at >= 2 and best[hull[at + 1]] - n[hull[at + 1]] * x <= best[hull[at]] - n[hull[at]] * x:
                at += 1
            if len(hull) > at:
                i = hull[at]
                new[j], came[j] = best[i] + (n[j] - n[i]) * x, i
        back.append(came)
        best = new
    cuts, j = [], size
    for came in reversed(back):
        cuts.append(ends[j - 1])
        j = came[j]
    return sorted(set(cuts))


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, block_rows: int = BLOCK_ROWS,
         seed: str = SEED) -> DataFrame:
    """doc_id, n_tokens, bucket (0 = shortest), bucket_len, batch (number inside the
    bucket), slot (place in the batch), batch_rows (capacity), padding."""
    sized = materialize(docs.select("doc_id", word_count(F.col("text")).alias("n_tokens")), "pack-sizes")
    hist = sized.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toPandas()
    rows = int(hist["n"].sum()) if len(hist) else 0
    # Length 0 needs no padding and is its own bucket; the programme places the others.
    some = hist[hist["n_tokens"] > 0]
    ends = boundaries(some["n_tokens"].to_numpy("i8"), some["n"].to_numpy("i8"), buckets)
    ends = ([0] if rows and len(some) < len(hist) else []) + ends
    n_blocks = max(1, -(-rows // block_rows))
    # One row per bucket; a range of lengths decides, so an expression over the ends, no join.
    bucket, size = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i in range(len(ends) - 1, -1, -1):
        here = F.col("n_tokens") <= ends[i]
        bucket, size = F.when(here, F.lit(i)).otherwise(bucket), F.when(here, F.lit(ends[i]).cast("long")).otherwise(size)
    placed = sized.withColumn("bucket", bucket).withColumn("bucket_len", size)
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    placed = ranked(placed, ["bucket"], [key, F.col("doc_id"), F.col("n_tokens")], F.pmod(key, F.lit(n_blocks)), "place")
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_len"), F.lit(1).cast("long"))).cast("long"))
    return (placed.withColumn("batch_rows", room)
            .withColumn("batch", F.floor(F.col("place") / F.col("batch_rows")).cast("long"))
            .withColumn("slot", (F.col("place") % F.col("batch_rows")).cast("int"))
            .withColumn("padding", F.col("bucket_len") - F.col("n_tokens"))
            .select("doc_id", "n_tokens", "bucket", "bucket_len", "batch", "slot", "batch_rows", "padding"))
