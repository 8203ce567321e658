"""Exact top-k search by tiled matrix products.

Vectors are quantised to integers and dealt over racks, in equal shares; a task holds
one rack (``RACK_BYTES`` of vectors of a length at most), and every block of queries
passes every rack once. Rows are shuffled by rack, vectors before blocks: nothing is
joined, so nothing can be broadcast. A worker multiplies a block with a rack tile by
tile (at most ``tile_rows`` vectors), keeps the k best per query by partial selection,
afterwards by what exceeds the k-th best so far, and the racks' lists are merged in a
tree of fan-in ``fan_in``.

Defined cases: null vectors, empty vectors and vectors that hold a null, NaN or
infinite component take no part; a query only meets vectors of its own length;
rows that share a query's id are not its candidates; of several vectors under one
query id the smallest (component by component) asks; ties go to the smaller id;
components are whole 64-bit numbers (beyond that, its ends) and sums wrap at 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TILE_ROWS = 4096
QUERY_ROWS = 512
FAN_IN = 16
FIRST_ROWS = 256
RACK_BYTES = 64 << 20       # as four-byte numbers
RACKS_PER_CORE = 3
ROW = "dim int, rack int, asks boolean, width int, ids binary, mat binary"


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component as long; null when the vector takes no part."""
    ok = vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(
        vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    q = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(ok, q)


def _by_length(batches):
    """(dim, ids, int64 matrix) for every vector length of every batch."""
    for t in batches:
        dims = np.asarray(t.column("dim"))
        for dim in np.unique(dims):
            own = t.filter(pa.array(dims == dim))
            yield int(dim), np.asarray(own.column("id"), "<i8"), np.asarray(own.column("vec").flatten(), "<i8").reshape(-1, dim)


def _packed(dim, asks, parts):
    """Rows of ``ROW`` for parts (rack, ids, matrix); a matrix goes in the smallest integers that hold it."""
    def narrow(m):
        low, high = m.min(initial=0), m.max(initial=0)
        return m.astype(next((t for t in ("<i1", "<i2", "<i4") if np.iinfo(t).min <= low and high <= np.iinfo(t).max), "<i8"))

    racks, ids, mats = zip(*((rack, i.tobytes(), narrow(m)) for rack, i, m in parts))
    n = len(racks)
    return pa.RecordBatch.from_pydict({
        "dim": pa.array([dim] * n, pa.int32()), "rack": pa.array(racks, pa.int32()), "asks": pa.array([asks] * n, pa.bool_()),
        "width": pa.array([m.itemsize for m in mats], pa.int32()), "ids": pa.array(ids, pa.binary()),
        "mat": pa.array([m.tobytes() for m in mats], pa.binary())})


def _norm(m, rows=TILE_ROWS):
    """The longest row's length."""
    parts = (m[i:i + rows].astype("f8") for i in range(0, len(m), rows))
    return max((float(np.sqrt(np.einsum("ij,ij->i", p, p).max())) for p in parts), default=0.0)


def _exact_type(bound):
    """By Cauchy-Schwarz no partial sum of products exceeds the product of the lengths; floats hold whole
    numbers exactly up to 2^24 and 2^53, beyond that sums wrap at 64 bits."""
    return "f4" if bound < 0.999 * 2.0 ** 24 else "f8" if bound < 0.999 * 2.0 ** 53 else "i8"


def _best(q_ids, c_ids, s, k):
    """k best candidates per row of the scores ``s``: arrays (row, id, score). Candidates' ids ascend."""
    rows, ids, scores = [], [], []
    n = len(c_ids)
    for i in range(len(q_ids)):
        line = s[i]
        own = np.searchsorted(c_ids, [q_ids[i], q_ids[i] + 1])
        live = np.ones(n, bool)
        live[own[0]:own[1]] = False
        want = min(k, int(live.sum()))
        if not want:
            continue
        pool = line[live]
        floor = np.partition(pool, len(pool) - want)[len(pool) - want]
        over = np.nonzero(live & (line > floor))[0]
        ties = np.nonzero(live & (line == floor))[0][: want - len(over)]    # ids ascend: smaller ids first
        got = np.concatenate([over, ties])
        rows.append(np.full(len(got), i)), ids.append(c_ids[got]), scores.append(line[got].astype("i8"))
    if not rows:
        return [np.empty(0, "i8")] * 3
    return [np.concatenate(x) for x in (rows, ids, scores)]


def _merge(a, b, k):
    """Merge two triples of lists and keep the k best per query row."""
    q, i, s = (np.concatenate(x) for x in zip(a, b))
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    first = np.r_[0, np.nonzero(np.diff(q))[0] + 1] if len(q) else np.empty(0, int)
    pos = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    keep = pos < k
    return [q[keep], i[keep], s[keep]]


def _set(flags, n):
    """Positions of the flags that are set among the first ``n``, which are few: eight at a time are looked at first."""
    flags[n:n + -n % 8] = False
    words = np.flatnonzero(flags[:n + -n % 8].view("u8"))
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return at[flags[at]]


class _Rack:
    """Vectors of one length in ascending order of their ids."""

    def __init__(self, parts, tile_rows):
        ids = np.concatenate([i for i, _ in parts])
        order = np.argsort(ids, kind="stable")
        self.ids, self.whole = ids[order], np.concatenate([m for _, m in parts])[order]
        self.norm, self.cast = _norm(self.whole), None
        n = len(ids)
        self.cuts = [0, *range(min(FIRST_ROWS, tile_rows), n, tile_rows), n]

    def search(self, q_ids, q, k):
        """k best candidates per query row: arrays (row, id, score)."""
        kind = _exact_type(_norm(q) * self.norm)
        if self.cast is None or self.cast.dtype != kind:
            self.cast = self.whole.astype(kind)
        q, got, floor, short = q.astype(kind), [np.empty(0, "i8")] * 3, None, None
        most = len(q) * max(hi - lo for lo, hi in zip(self.cuts, self.cuts[1:]))
        room, flags = np.empty(most, kind), np.zeros(most + 7, bool)     # new ones a tile would cost more than the product
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            ids, shape = self.ids[lo:hi], (len(q), hi - lo)
            size = len(q) * (hi - lo)
            s = np.matmul(q, self.cast[lo:hi].T, out=room[:size].reshape(shape))
            if floor is not None:
                # Later tiles have no smaller ids: what only equals the k-th best so far is behind it.
                over = np.greater(s, floor[:, None], out=flags[:size].reshape(shape))
                over[short] = True
                if not (n := np.count_nonzero(over)):
                    continue
            if floor is None or n > size // 8:
                new = _best(q_ids, ids, s, k)
            else:
                row, col = np.divmod(_set(flags, size), hi - lo)
                other = ids[col] != q_ids[row]
                row, col = row[other], col[other]
                new = [row, ids[col], s[row, col].astype("i8")]
            got = _merge(got, new, k)
            found = np.bincount(got[0], minlength=len(q_ids))
            short = found < k
            floor = np.zeros(len(q_ids), kind)
            floor[~short] = got[2][np.cumsum(found)[~short] - 1]
        return got


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, tile_rows: int = TILE_ROWS,
          query_rows: int = QUERY_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``vectors`` and ``queries``: (id long, vec array<double|float>). Returns
    (query_id, rank, id, score): each query's k highest integer inner products."""
    def usable(df):
        return (df.select(F.col("id").cast("long").alias("id"), quantised(F.col("vec"), scale).alias("vec"))
                .where("id is not null and vec is not null").withColumn("dim", F.size("vec")))

    cand, asked = usable(vectors), usable(queries).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    most = (cand.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max(F.ceil(F.col("n") / tile_rows)).alias("tiles"), F.max(F.ceil(F.col("n") * F.col("dim") * 4 / RACK_BYTES)).alias("full"))
            .first())
    # Enough racks for every core, and none that a worker could not hold.
    n_racks = max(1, most["full"] or 0, min(most["tiles"] or 0, RACKS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism))

    def deal(batches):
        at = TaskContext.get().partitionId()
        for dim, ids, m in _by_length(batches):
            yield _packed(dim, False, [((at + j) % n_racks, ids[j::n_racks], m[j::n_racks]) for j in range(min(n_racks, len(ids)))])
            at += len(ids)

    def block(batches):
        for dim, ids, m in _by_length(batches):
            yield _packed(dim, True, [(0, ids[j:j + query_rows], m[j:j + query_rows]) for j in range(0, len(ids), query_rows)])

    def search(batches):
        at, parts, rack, waiting = None, [], None, []

        def answers():
            q_ids, q = (np.concatenate(x) for x in zip(*waiting))
            row, ids, scores = rack.search(q_ids, q, k)
            return pa.RecordBatch.from_pydict({"query_id": q_ids[row], "id": ids, "score": scores, "part": np.full(len(row), at[0], "i8")})

        for b in batches:
            for j in range(b.num_rows):
                dim, of, asks, width, ids, mat = (b.column(c)[j].as_py() for c in ("dim", "rack", "asks", "width", "ids", "mat"))
                if (of, dim) != at:
                    if waiting:
                        yield answers()
                    at, parts, rack, waiting = (of, dim), [], None, []
                one = np.frombuffer(ids, "<i8"), np.frombuffer(mat, f"<i{width}").reshape(-1, dim)
                if not asks:
                    parts.append(one)
                elif parts or rack:
                    if rack is None:
                        rack, parts = _Rack(parts, tile_rows), []
                    waiting.append(one)
                    if sum(len(i) for i, _ in waiting) >= query_rows:
                        yield answers()
                        waiting = []
        if waiting:
            yield answers()

    every = F.explode(F.sequence(F.lit(0), F.lit(n_racks - 1)))
    met = cand.mapInArrow(deal, ROW).unionByName(asked.mapInArrow(block, ROW).withColumn("rack", every))
    lists = (met.repartitionById(n_racks, F.col("rack")).sortWithinPartitions("rack", "dim", "asks")
             .mapInArrow(search, "query_id long, id long, score long, part long"))
    # Tree merge: lists of fan_in racks meet, then their winners, up to one list a query.
    width = n_racks
    while True:
        width = -(-width // fan_in)
        lists = lists.withColumn("part", F.floor(F.col("part") / fan_in))
        w = W.partitionBy("query_id", "part").orderBy(F.desc("score"), "id")
        lists = lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if width <= 1:
            return lists.select("query_id", "rank", "id", "score")
