"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document is a sparse vector with x = (10^9 tf) div (1000 tf + 8 m) for a term, a
query is one with the weights w of its distinct terms; the score is their inner
product in integers.

1. Items go in blocks (about ``ITEMS`` items and ``TERMS`` distinct terms, a long item
   alone). Per block the documents are scanned once: numpy finds and hashes
   their terms, keeps those of the block's vocabulary and writes them to the
   shared folder, with the number of all terms; the same table gives N, L and df.
2. A task reads its documents in tiles of ``TILE`` and builds a ball tree over each:
   a node is split by the projection on the line through two far points and
   knows its centroid c, its radius R (largest distance of a document from c) and
   the vocabulary terms below it.
3. A node's bound for a query is <q, c> + |q on the node's terms| * R, widened by more
   than all rounding of its float64 arithmetic. The node of the highest bound is
   opened first; queries whose tenth best score so far is above its bound leave
   it, and a node without queries is pruned with all below it. The lists are carried
   from tile to tile, so later trees prune with sharper thresholds.
4. Leaves score exactly: integer products and sums below 2^53 are exact in float64
   matrix products; where they could be larger, int64 is used.
5. A task gives at most ``k`` rows an item; lists are merged in two steps.

Defined cases: null texts and texts without a term are in no statistics (N counts
documents with a term) and have no score; items without a term or without a scoring
document give no rows; rows of one item_id are one item over all their terms (a null
id too); rows without doc_id rank after equal scores; repeated rows rank
side by side; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize
from .textscan import Scanner, byte_set, slices

TERM_BYTES = np.concatenate([byte_set(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")[:128], np.ones(128, bool)])
TOP = 10
ITEMS = 256
TERMS = 32_768                       # 64 MB of weights a block of queries
TILE = 8192
LEAF = 64
SLACK = 1e-9                         # relative widening of a bound: float64 sums of up to 10^5 terms err by less than 10^-10
LAST = np.iinfo("i8").max            # stands for a null id


def _scanner() -> Scanner:
    return Scanner(TERM_BYTES, 21)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term): the distinct term hashes of every item."""
    def run(batches):
        scan = _scanner()
        for b in batches:
            ids = b.column("item_id")
            for s in slices(b.column("text")):
                start, _, h = scan.find(s.data)
                pairs = np.unique(np.stack([s.owner(start).astype("u8"), h]), axis=1) if len(h) else np.empty((2, 0), "u8")
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(pairs[0].astype("i8") + s.rows.start)), pa.array(pairs[1].view("i8"))],
                                                 names=["item", "term"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item long, term long").distinct()


def item_blocks(terms: DataFrame, items: int = ITEMS, most: int = TERMS) -> list[DataFrame]:
    """(item, term) of one block each. An item takes up a share of a block, 1 / ``items`` or its terms / ``most``; items of
    half a block or more are alone, the others are dealt by hash into blocks that are a quarter full on average."""
    per = terms.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    per = materialize(per.withColumn("share", F.greatest(F.lit(1 / items), F.col("n") / most)), "search-shares")
    total = per.agg(F.sum("share").alias("all"), F.sum(F.when(F.col("share") < 0.5, F.col("share"))).alias("small")).first()
    if not total["all"]:
        return []
    if total["all"] <= 1:
        return [terms]
    parts = max(1, int(-(-4 * (total["small"] or 0) // 1)))
    small = terms.join(per.where("share < 0.5").select(F.col("item").alias("_i")), F.col("item").eqNullSafe(F.col("_i")), "left_semi")
    blocks = [small.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == p) for p in range(parts)]
    alone = [r["item"] for r in per.where("share >= 0.5").select("item").collect()]
    return blocks + [terms.where(F.col("item").eqNullSafe(F.lit(i).cast("long"))) for i in alone]


def document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, at, tf) of the documents with a term: n terms with repeats; vocabulary numbers (int32) and
    their occurrences (int32) as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        scan, words = _scanner(), shared.value
        for b in batches:
            ids = b.column("doc_id")
            for s in slices(b.column("text")):
                start, _, h = scan.find(s.data)
                owner = s.owner(start)
                n = np.bincount(owner, minlength=len(s.rows))
                at = np.minimum(np.searchsorted(words, h), len(words) - 1)
                hit = words[at] == h
                pair, tf = np.unique(owner[hit] * len(words) + at[hit], return_counts=True)
                doc, term = pair // len(words), (pair % len(words)).astype("<i4")
                cut = np.searchsorted(doc, np.arange(len(s.rows) + 1))
                some = np.flatnonzero(n)
                tf = tf.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(some + s.rows.start)), pa.array(n[some].astype("i8")),
                     pa.array([term[cut[d]:cut[d + 1]].tobytes() for d in some], pa.binary()),
                     pa.array([tf[cut[d]:cut[d + 1]].tobytes() for d in some], pa.binary())], names=["doc_id", "n", "at", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").mapInArrow(
        run, "doc_id long, n long, at binary, tf binary")


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """df of every vocabulary number; a task sends one row a number it met."""
    def run(batches):
        df = np.zeros(size, "i8")
        for b in batches:
            for raw in b.column("at").to_pylist():
                df[np.frombuffer(raw, "<i4")] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"at": some.astype("i4"), "df": df[some]})

    out = np.zeros(size, "i8")
    for r in rows.select("at").mapInArrow(run, "at int, df long").groupBy("at").agg(F.sum("df").alias("df")).collect():
        out[r["at"]] = r["df"]                           # as many numbers as a block has terms
    return out


class Tile:
    """Sparse rows of one tile: term numbers and integer values, row by row."""

    def __init__(self, ids, at, value):
        self.ids = np.asarray(ids, "i8")
        self.cut = np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype("i8")
        self.at = np.concatenate(at).astype("i8") if at else np.empty(0, "i8")
        self.value = np.concatenate(value).astype("f8") if value else np.empty(0)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.cut))
        self.norm = np.bincount(self.row, self.value ** 2, len(self.ids))

    def dot(self, dense: np.ndarray, lo: int, hi: int) -> np.ndarray:
        a, b = self.cut[lo], self.cut[hi]
        return np.bincount(self.row[a:b] - lo, self.value[a:b] * dense[self.at[a:b]], hi - lo)

    def ordered(self, rows: np.ndarray, lo: int) -> None:
        """Puts the rows lo, lo + 1, ... into the given order."""
        hi = lo + len(rows)
        a, b = self.cut[lo], self.cut[hi]
        sizes = np.diff(self.cut)[rows]
        take = np.repeat(self.cut[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(b - a)
        self.at[a:b], self.value[a:b] = self.at[take], self.value[take]
        self.cut[lo + 1:hi + 1] = a + np.cumsum(sizes)
        self.row[a:b] = np.repeat(np.arange(lo, hi), sizes)
        self.ids[lo:hi], self.norm[lo:hi] = self.ids[rows], self.norm[rows]


class Node:
    """Rows lo..hi of a tile under one ball."""

    def __init__(self, tile: Tile, lo: int, hi: int, size: int):
        self.lo, self.hi, self.below = lo, hi, ()
        a, b = tile.cut[lo], tile.cut[hi]
        total = np.bincount(tile.at[a:b], tile.value[a:b], size)
        self.terms = np.unique(tile.at[a:b])
        self.centre = total[self.terms] / (hi - lo)
        dense = total / (hi - lo)
        far = tile.norm[lo:hi] - 2 * tile.dot(dense, lo, hi) + dense @ dense
        # The three terms err by less than SLACK of the largest.
        slack = SLACK * (tile.norm[lo:hi].max() + dense @ dense)
        self.radius = float(np.sqrt(max(0.0, far.max()) + slack))
        self.far = lo + int(far.argmax())


def build(tile: Tile, size: int, leaf: int = LEAF) -> Node:
    """The ball tree of a tile; rows of a node are neighbours in the tile."""
    root = Node(tile, 0, len(tile.ids), size)
    todo = [root]
    while todo:
        node = todo.pop()
        lo, hi = node.lo, node.hi
        if hi - lo <= leaf:
            continue
        p = np.zeros(size)
        a, b = tile.cut[node.far], tile.cut[node.far + 1]
        p[tile.at[a:b]] = tile.value[a:b]
        away = tile.norm[lo:hi] - 2 * tile.dot(p, lo, hi)
        other = lo + int(away.argmax())
        a, b = tile.cut[other], tile.cut[other + 1]
        p[tile.at[a:b]] -= tile.value[a:b]
        along = tile.dot(p, lo, hi)
        tile.ordered(lo + np.argsort(along, kind="stable"), lo)
        mid = (lo + hi) // 2
        node.below = (Node(tile, lo, mid, size), Node(tile, mid, hi, size))
        todo.extend(node.below)
    return root


def bounds(node: Node, weights: np.ndarray) -> np.ndarray:
    """Upper bound of every query's score below the node."""
    w = weights[node.terms]
    got = node.centre @ w + np.sqrt(np.einsum("tq,tq->q", w, w)) * node.radius
    return got * (1 + SLACK) + 1


class Lists:
    """The best k (score, id) of every query; equal scores by ascending id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.zeros((queries, k), "i8")
        self.id = np.full((queries, k), LAST)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, queries: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """score: documents x queries."""
        ok = (score >= np.maximum(self.least()[queries], 1)).any(axis=0)
        queries, score = queries[ok], score[:, ok]
        if not len(queries):
            return
        s = np.concatenate([self.score[queries], score.T], axis=1)
        i = np.concatenate([self.id[queries], np.broadcast_to(ids, score.T.shape)], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[queries], self.id[queries] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search(tile: Tile, weights: np.ndarray, lists: Lists, exact_float: bool, leaf: int = LEAF) -> int:
    """Best-first search of all queries below the tree of one tile; returns the number of scored (leaf, query) pairs."""
    size, scored = len(weights), 0
    root = build(tile, size, leaf)
    heap, n = [(0.0, 0, root, np.arange(weights.shape[1]), bounds(root, weights))], 1
    while heap:
        _, _, node, queries, up = heapq.heappop(heap)
        open_ = (up >= lists.least()[queries]) & (up > 1)
        queries = queries[open_]
        if not len(queries):
            continue
        if node.below:
            for child in node.below:
                b = bounds(child, weights[:, queries])
                heapq.heappush(heap, (-float(b.max()), n, child, queries, b))
                n += 1
            continue
        a, b = tile.cut[node.lo], tile.cut[node.hi]
        kind = "f8" if exact_float else "i8"
        x = np.zeros((node.hi - node.lo, len(node.terms)), kind)
        x[tile.row[a:b] - node.lo, np.searchsorted(node.terms, tile.at[a:b])] = tile.value[a:b]
        score = x @ weights[np.ix_(node.terms, queries)].astype(kind, copy=False)
        lists.add(queries, score.astype("i8"), tile.ids[node.lo:node.hi])
        scored += len(queries)
    return scored


def search_block(docs: DataFrame, terms: DataFrame, k: int = TOP, tile_rows: int = TILE, leaf: int = LEAF) -> DataFrame:
    """(item, doc_id, score): at most k rows an item and task. The block's items and terms (bounded by ITEMS and TERMS)
    are held by the driver and every task."""
    spark = docs.sparkSession
    pairs = terms.select(F.coalesce("item", F.lit(LAST)).alias("item"), "term").toArrow()
    if not pairs.num_rows:
        return spark.createDataFrame([], "item long, doc_id long, score long")
    items, query = np.unique(pairs.column("item").to_numpy(), return_inverse=True)
    vocabulary, at = np.unique(pairs.column("term").to_numpy().view("u8"), return_inverse=True)
    rows = materialize(document_terms(docs, vocabulary), "search-terms")
    total = rows.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, length = total["N"], total["L"] or 0
    df = document_counts(rows, len(vocabulary))
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype("i8")
    weights = np.zeros((len(vocabulary), len(items)))
    weights[at, query] = w[at]
    exact_float = bool(weights.sum(axis=0).max() * 1_000_000 < 2 ** 53)
    shared = spark.sparkContext.broadcast((weights, items, n_docs, length))

    def run(batches):
        weights, items, n_docs, length = shared.value
        lists, ids, cols, values = Lists(len(items), k), [], [], []

        def flush():
            search(Tile(ids, cols, values), weights, lists, exact_float, leaf)
            for held in (ids, cols, values):
                held.clear()

        for b in batches:
            for i, n, at, tf in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "at", "tf"))):
                if not at:
                    continue
                m, tf = 10 + 90 * n * n_docs // length, np.frombuffer(tf, "<i4").astype("i8")
                ids.append(LAST if i is None else i)
                cols.append(np.frombuffer(at, "<i4"))
                values.append(1_000_000_000 * tf // (1000 * tf + 8 * m))
                if len(ids) == tile_rows:
                    flush()
        if ids:
            flush()
        q, r = np.nonzero(lists.score > 0)
        ids_out, item_out = lists.id[q, r], items[q]
        yield pa.RecordBatch.from_arrays([pa.array(item_out, mask=item_out == LAST), pa.array(ids_out, mask=ids_out == LAST),
                                          pa.array(lists.score[q, r])], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    found = None
    for block in item_blocks(materialize(item_terms(items), "search-items")):
        part = materialize(search_block(docs, block, k), "search-lists")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Lists of many tasks are merged in two steps, so one item's lists never meet in a single task at once.
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    for keys in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= k)
    return found.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
