"""Near duplicates by one-permutation hashing with optimal densification.

Two texts are linked when 100 * |A and B| >= 85 * |A or B| for their sets of
distinct five-word shingles (A-Z lower-cased; a text of fewer words is one shingle).

1. Texts of one set are one class, whatever their number; only classes are compared.
2. One permutation: a shingle hash falls into one of ``BINS`` bins and each bin keeps
   its least hash. An empty bin copies a bin that its own universal hash sequence
   reaches first (optimal densification), so every bin agrees with a chance of
   about the similarity. A bin's token has 16 bits; ``ROWS`` tokens are a band, whose
   key is the tokens themselves.
3. Banded buckets and stars: the least class of a bucket is its centre, every other
   class has an edge to it (never to each other), and a class keeps one centre.
   Edges are confirmed on full sets, the confirmed ones give a first grouping. The
   next round takes other centres in the buckets that still hold several groups.
4. What stars cannot decide - two classes of one bucket in different groups that were
   never a centre of each other - is compared in tiles of bounded size: the largest
   group of a bucket meets only the classes outside it, the signatures screen the
   pairs, full sets confirm. So no link between classes that share a bucket is
   lost and no pair is ever listed: tiles give one row a class.
   A linked pair shares no bucket with a chance below 1e-9 for larger sets.
5. Connected parts by alternating stars over class numbers, written each round.

Result: doc_id, n_shingles, component_id (least doc_id reachable), kept
(doc_id = component_id).

Defined cases: null, empty or blank texts have no shingles and are linked with
nothing (component_id is the row's own id); a row without an id takes no part in
groups and has component_id and kept null; rows of one id but different texts are
different nodes; repeated rows are copies; an empty table gives no rows; extra
columns are ignored. Texts are read whole, in slices of bounded memory.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_per_key
from .common import materialize
from .ngram_join import _all_pairs, _groups, components, overlaps
from .textscan import Scanner, bitmix, byte_set, slices

WORDS = 5
PERCENT = 85
BINS = 128
ROWS = 4                             # 16-bit tokens of a band: its key has 64 bits
BANDS = BINS // ROWS
ATTEMPTS = 4096
STAR_ROUNDS = 2
CHUNK = 256                          # members of a star that are confirmed together
BLOCK = 512                          # classes in a block of a tile
SCREEN_SIGMA = 4.5
MAX_BROADCAST = 1_000_000
U = np.uint64


class Shingles:
    """Sorted distinct shingle hashes of every text of a slice."""

    def __init__(self, words: int = WORDS):
        self.n, self.scan = words, Scanner(~byte_set(b" \t\n\x0b\x0c\r"), 11)

    def __call__(self, s):
        start, _, h = self.scan.find(s.data)
        owner = s.owner(start)
        ends = np.searchsorted(owner, np.arange(len(s.rows) + 1))
        runs = self.scan.sequences(h, self.n)
        for a, b in zip(ends[:-1], ends[1:]):
            if b - a >= self.n:
                yield np.unique(runs[a:b - self.n + 1])
            else:
                yield self.scan.sequences(h[a:b], int(b - a)) if b > a else np.empty(0, "u8")


def _sequence_table() -> np.ndarray:
    """For every attempt and bin the bin to copy from."""
    x = np.arange(ATTEMPTS * BINS, dtype="u8").reshape(ATTEMPTS, BINS)
    return (bitmix(x + U(0x5851F42D4C957F2D)) >> U(64 - int(math.log2(BINS)))).astype("i2")


def signatures(sets: list[np.ndarray], table: np.ndarray | None = None) -> np.ndarray:
    """Tokens (n x BINS, 16 bits) of non-empty sets."""
    table = _sequence_table() if table is None else table
    n = len(sets)
    if not n:
        return np.empty((0, BINS), "<u2")
    hashed = bitmix(np.concatenate(sets) ^ U(0xA24BAED4963EE407))
    cell = np.repeat(np.arange(n), [len(x) for x in sets]) * BINS + (hashed >> U(57)).astype("i8")
    low = np.full(n * BINS, U(2 ** 64 - 1))
    order = np.lexsort((hashed, cell))
    cell, hashed = cell[order], hashed[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    low[cell[first]] = hashed[first]
    full = np.zeros(n * BINS, bool)
    full[cell[first]] = True
    empty = np.flatnonzero(~full)
    source = np.arange(n * BINS)
    for row in table:
        if not len(empty):
            break
        to = empty - empty % BINS + row[empty % BINS]
        hit = full[to]
        source[empty[hit]] = to[hit]
        empty = empty[~hit]
    if len(empty):                                       # the hash sequence met no full bin: the set's first one
        base = np.searchsorted(cell[first] // BINS, empty // BINS)
        source[empty] = cell[first][base]
    return (bitmix(low[source] + U(0x2545F4914F6CDD1D)) >> U(48)).astype("<u2").reshape(n, BINS)


def sketch(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, key (128 bits of the set; null without words), tokens."""
    def run(batches):
        shingles, table = Shingles(words), _sequence_table()
        for b in batches:
            size, keys, toks = np.zeros(b.num_rows, "i8"), [None] * b.num_rows, [None] * b.num_rows
            for s in slices(b.column("text")):
                sets = list(shingles(s))
                size[s.rows.start:s.rows.stop] = [len(x) for x in sets]
                some = [i for i, x in enumerate(sets) if len(x)]
                for i, t in zip(some, signatures([sets[i] for i in some], table)):
                    keys[s.rows[i]], toks[s.rows[i]] = xxhash.xxh3_128_digest(sets[i].tobytes()), t.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(keys, pa.binary()), pa.array(toks, pa.binary())],
                                             names=["doc_id", "n_shingles", "key", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, key binary, tokens binary")


def band_keys(tokens: np.ndarray) -> np.ndarray:
    """n x BANDS bucket numbers: the tokens of a band, mixed with the band's place."""
    keys = np.ascontiguousarray(tokens).view("<u8")
    with np.errstate(over="ignore"):
        return bitmix(keys ^ bitmix(np.arange(1, keys.shape[1] + 1, dtype="u8") * U(0x9E3779B97F4A7C15)))


def _tokens(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BINS)


def buckets(classes: DataFrame) -> DataFrame:
    """(path, node): the BANDS buckets of every class."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                keys = band_keys(_tokens(b.column("tokens")))
                yield pa.RecordBatch.from_pydict({"path": keys.view("i8").ravel(),
                                                  "node": np.repeat(np.asarray(b.column("node")), keys.shape[1])})

    return classes.select("node", "tokens").mapInArrow(run, "path long, node long")


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact test on two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the classes in ``nodes``, read again from the text of their smallest id."""
    wanted = classes.select("node", "key", F.col("rep").alias("doc_id")).join(nodes, "node", "left_semi")
    wanted = materialize(wanted, "minhash-wanted")
    ids = wanted.select("doc_id").distinct()
    ids = F.broadcast(ids) if wanted.count() <= MAX_BROADCAST else ids

    def run(batches):
        shingles = Shingles(words)
        for b in batches:
            for s in slices(b.column("text")):
                sets = list(shingles(s))
                yield pa.RecordBatch.from_pydict({"key": pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                                                  "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(run, "key binary, shingles binary")
    # Rows of one id and one set would repeat a class; it has one row here.
    return wanted.select("node", "key").join(sets, "key").groupBy("node").agg(F.min("shingles").alias("shingles"))


def confirm_stars(edges: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (centre, node), one a node, that are links. A star's members are split into chunks, each with a
    copy of the centre's set, so a star of any size is spread over tasks."""
    n = edges.groupBy("centre").agg(F.count(F.lit(1)).alias("n"))
    chunks = n.select("centre", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    # The chunk comes from the member alone; its range is the chunk number of the largest star (a power of two above it).
    most = chunks.agg(F.max("chunks")).first()[0] or 1
    salted = edges.withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(1 << (most - 1).bit_length())).cast("int"))
    heads = salted.select("centre", "chunk").distinct()
    nodes = materialize(edges.select("node").unionByName(edges.select(F.col("centre").alias("node"))).distinct(), "minhash-nodes")
    sets = materialize(full_sets(docs, classes, nodes, words), "minhash-sets")
    rows = (salted.join(sets, "node").select("centre", "chunk", "node", "shingles")
            .unionByName(heads.join(sets.withColumnRenamed("node", "centre"), "centre")
                         .select("centre", "chunk", F.lit(None).cast("long").alias("node"), "shingles")))

    def run(batches):
        at, head = None, None
        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("centre", "chunk", "node", "shingles")]
            for centre, chunk, node, raw in zip(*cols):
                own = np.frombuffer(raw, "<u8")
                if node is None:
                    at, head = (centre, chunk), own
                elif at == (centre, chunk) and linked(head, own, percent):
                    out.append((centre, node))
            if out:
                a, c = zip(*out)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})

    keys = ["centre", "chunk"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, F.col("node").asc_nulls_first()).mapInArrow(run, "a long, b long")


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """+ root: the group of a class (itself while it has no link)."""
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def open_buckets(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(path, node, root) of the buckets that hold several groups, with n (classes), most (the largest group's root)
    and n_most. Counted before the shuffle, so a large bucket is one row a task there."""
    rows = _rooted(rows, roots)
    groups = rows.groupBy("path", "root").agg(F.count(F.lit(1)).alias("c"))
    several = (groups.groupBy("path").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("g"),
                                          F.max(F.struct("c", "root")).alias("m")).where("g > 1")
               .select("path", "n", F.col("m.root").alias("most"), F.col("m.c").alias("n_most")))
    return join_per_key(rows, materialize(several, "minhash-open"), ["path"], "inner")


def tiles(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Open buckets as tiles (path, ti, tj, side, node, root). Classes outside the largest group lie in the first
    blocks and meet every block; those of the largest group meet only these."""
    n_out = F.col("n") - F.col("n_most")
    small = F.col("n") <= 2 * block
    out = F.when(small, F.lit(1)).otherwise(F.ceil(n_out / block)).cast("int")
    inside = F.when(small, F.lit(0)).otherwise(F.ceil(F.col("n_most") / block)).cast("int")
    mix = F.xxhash64("node", "path")
    d = rows.withColumn("_o", out).withColumn("_i", inside)
    side = F.when(F.col("_i") == 0, F.lit(0)).when(F.col("root") == F.col("most"), F.col("_o") + F.pmod(mix, F.col("_i"))) \
        .otherwise(F.pmod(mix, F.col("_o"))).cast("int")
    d = d.withColumn("side", side).withColumn("_last", F.when(F.col("side") < F.col("_o"), F.col("_o") + F.col("_i")).otherwise(F.col("_o")) - 1)
    return (d.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_last"))))
            .select("path", F.least("side", "_other").alias("ti"), F.greatest("side", "_other").alias("tj"), "side", "node", "root"))


def screen(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The classes of each tile that are in some pair of different groups whose signatures allow a link; a pair is
    looked at in its first common band only."""
    p = percent / 100
    least = math.floor(BINS * p - SCREEN_SIGMA * math.sqrt(BINS * p * (1 - p)))

    def run(batches):
        for t, bounds in _groups(batches):
            toks = _tokens(t.column("tokens"))
            bands = np.ascontiguousarray(toks).view("<u8")
            mine = (band_keys(toks).view("i8") == np.asarray(t.column("path"))[:, None]).argmax(axis=1)
            root, size = np.asarray(t.column("root")), np.asarray(t.column("size"))
            side, ti, tj = (np.asarray(t.column(c)) for c in ("side", "ti", "tj"))
            need = np.zeros(t.num_rows, bool)
            for i, j in _all_pairs(bounds, side, ti, tj):
                ok = (root[i] != root[j]) & ((ti[i] == tj[i]) | (side[i] != side[j]))
                ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
                i, j = i[ok], j[ok]
                for at in range(0, len(i), 50_000):
                    x, y = i[at:at + 50_000], j[at:at + 50_000]
                    near = (bands[x] == bands[y]).argmax(axis=1) == mine[x]
                    x, y = x[near], y[near]
                    near = (toks[x] == toks[y]).sum(axis=1) >= np.where(np.minimum(size[x], size[y]) < 4 * BINS, 0, least)
                    need[x[near]] = True
                    need[y[near]] = True
            if need.any():
                yield from t.filter(pa.array(need)).select(["path", "ti", "tj", "side", "node", "root"]).combine_chunks().to_batches()

    return rows.mapInArrow(run, "path long, ti int, tj int, side int, node long, root long")


def confirm_tiles(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links between groups of each tile, as (a, b): a class and the least class of its linked part of the tile."""
    def run(batches):
        for t, bounds in _groups(batches):
            node, root = np.asarray(t.column("node")), np.asarray(t.column("root"))
            sets = [np.frombuffer(x, "<u8") for x in t.column("shingles").to_pylist()]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                size = np.array([len(x) for x in sets[lo:hi]], "i8")
                both = np.rint(overlaps(sets[lo:hi])).astype("i8")
                ok = 100 * both >= percent * (size[:, None] + size[None, :] - both)
                i, j = np.nonzero(np.triu(ok & (root[lo:hi, None] != root[None, lo:hi]), 1))
                if not len(i):
                    continue
                low = node[lo:hi].copy()
                while True:                              # least class spreads along the links of the tile
                    before = low.copy()
                    np.minimum.at(low, i, before[j])
                    np.minimum.at(low, j, before[i])
                    if (low == before).all():
                        break
                some = np.unique(np.concatenate([i, j]))
                yield pa.RecordBatch.from_pydict({"a": node[lo:hi][some], "b": low[some]})

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rounds: int = STAR_ROUNDS,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    marks = materialize(sketch(docs, words), "minhash-marks")
    real = marks.where("key is not null and doc_id is not null")
    classes = real.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("tokens").alias("tokens"), F.min("n_shingles").alias("size"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    rows = buckets(classes)
    shared = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).where("n > 1")
    rows = materialize(join_per_key(rows, materialize(shared, "minhash-shared"), ["path"], "inner"), "minhash-buckets")
    edges = (rows.where("node != centre").groupBy("node").agg(F.min("centre").alias("centre")))
    rows = rows.select("path", "node")
    links = roots = None
    for turn in range(rounds):
        edges = materialize(edges, "minhash-stars")
        if not edges.limit(1).count():
            break
        found = materialize(confirm_stars(edges, docs, classes, words, percent), "minhash-links")
        links = found if links is None else links.unionByName(found)
        roots = materialize(components(links).withColumnRenamed("node", "node"), "minhash-roots")
        if turn + 1 < rounds:
            several = open_buckets(rows, roots)
            # New centres: seeded, one a bucket; a class takes one centre outside its own group.
            pick = several.groupBy("path").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("centre"),
                                                              F.col("root").alias("centre_root"))).alias("c")).select("path", "c.*")
            edges = (join_per_key(several, materialize(pick, "minhash-centres"), ["path"], "inner")
                     .where("root != centre_root").groupBy("node").agg(F.min("centre").alias("centre")))
    if links is not None:
        rest = tiles(open_buckets(rows, roots), block)
        tile = ["path", "ti", "tj"]
        likely = rest.join(classes.select("node", "tokens", "size"), "node").repartition(*tile).sortWithinPartitions(*tile)
        likely = materialize(screen(likely, percent), "minhash-likely")
        if likely.limit(1).count():
            nodes = materialize(likely.select("node").distinct(), "minhash-nodes")
            sets = full_sets(docs, classes, nodes, words)
            found = confirm_tiles(likely.join(sets, "node").repartition(*tile).sortWithinPartitions(*tile, "node"), percent)
            links = links.unionByName(materialize(found, "minhash-links"))
            roots = components(links)
        named = _rooted(classes.select("node", "key", "rep"), roots)
        least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = named.join(least, "root").select("key", "component_id")
    else:
        named = classes.select("key", F.col("rep").alias("component_id"))
    grouped = join_per_key(real.select("doc_id", "n_shingles", "key"), named, ["key"], "inner").drop("key")
    alone = marks.where("key is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
