"""N-gram Jaccard join by chosen paths.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles (lower-cased words; a shorter text is one shingle) is at least 0.8.

1. Exact copies (one text hash) are folded into a class with a number of its own; only
   classes are joined, so copies are never paired and equal ids never mix texts.
2. Every set is embedded into ``SLOTS`` min-hash tokens; the share of equal tokens
   estimates the similarity.
3. Chosen paths: a run starts with one bucket of all sets. A bucket picks one or
   two token slots by its own hash (1 / 0.8 on average) and splits its sets by
   the values there. Buckets of one set end; those of up to ``LEAF`` sets are brute-
   forced; larger ones are split again, ``LEVELS`` times at most. Buckets still large
   then (groups of near copies, which no split can part) are brute-forced in
   tiles of two blocks, so one group is spread over tasks and nothing is capped.
   A similar pair stays together in one run with a chance of about 0.64 or more
   at the threshold, so runs are repeated until ``TARGET_RECALL``.
4. Brute force, first on tokens: pairs whose estimate is far below the threshold
   are dropped, and a pair that shares several buckets counts in the smallest
   one only. The sets still needed meet there again with their shingles and
   the exact similarity decides. A tile yields one row a set (its number of
   links and the smallest id of its connected part), never a row a pair.
5. Connected parts of tiles are merged by alternating stars over those rows,
   each round written to the shared folder.

Result: one row a document: class_id (smallest id of its group of linked texts),
text_id (smallest id with exactly this text), n_copies (rows with this text),
n_links (other texts linked to this text).

Defined cases: texts null or without a word have no shingles, no copies and no
links; a row without an id is returned with class_id null; rows that share an
id but not a text belong to the groups of their texts; equal rows are copies of each
other; an empty table gives no rows; extra columns are ignored.
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

WORDS = 5
THRESHOLD = 0.8
SLOTS = 128
LEAF = 200
LEVELS = 3
TARGET_RECALL = 0.9995
MISS = 0.36                      # chance that one run of three levels parts a pair at the threshold
BLOCK = 512                      # sets in a block of a tile
SCREEN_SIGMA = 4.5
MAX_BROADCAST_IDS = 1_000_000
CACHE = 500_000
GOLD = np.uint64(0x9E3779B97F4A7C15)
U = np.uint64


def mix(x):
    """Bit mixing of uint64 values (array)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class Shingler:
    """Text -> sorted distinct 64-bit shingle hashes; word hashes are remembered up to CACHE words."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def __call__(self, text) -> np.ndarray:
        parts = text.lower().split() if text else []
        if not parts:
            return np.empty(0, "u8")
        known, h = self.known, np.empty(len(parts), "u8")
        for i, w in enumerate(parts):
            x = known.get(w)
            if x is None:
                if len(known) >= CACHE:
                    known.clear()
                x = known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            h[i] = x
        n = min(self.words, len(parts))
        with np.errstate(over="ignore"):
            s = np.zeros(len(h) - n + 1, "u8")
            for k in range(n):
                s = s * GOLD + h[k:len(h) - n + 1 + k]
        return np.unique(mix(s))


FACTORS = mix(np.arange(1, SLOTS + 1, dtype="u8") * GOLD) | U(1)


def low_hashes(shingles: np.ndarray) -> np.ndarray:
    """The SLOTS min-hash values, 64 bits."""
    low = np.full(SLOTS, np.iinfo("u8").max, "u8")
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):         # bounded memory for very long texts
            part = shingles[at:at + 2048]
            low = np.minimum(low, (part[None, :] * FACTORS[:, None]).min(axis=1))
    return mix(low)


def tokens(low: np.ndarray) -> np.ndarray:
    """Their 16-bit tokens: enough to compare sets that share a bucket."""
    return (low >> U(48)).astype("<u2")


def text_key(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def sketch(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, key (text hash; null without words), tokens (bytes), paths (the first buckets of every run). The first
    split uses whole hashes: with short tokens unrelated sets would meet more often the more sets there are."""
    roots = [mix(np.array([r + 1], "u8") * GOLD)[0] for r in range(runs)]

    def run(batches):
        shingle = Shingler()
        for b in batches:
            keys, low, at = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                s = shingle(text)
                keys.append(text_key(text) if len(s) else None)
                if len(s):
                    low.append(low_hashes(s))
                    at.append(i)
            low, at = np.array(low, "u8").reshape(-1, SLOTS), np.array(at, "i8")
            parts = [split(np.full(len(low), r, "u8"), low) for r in roots]
            rows = at[np.concatenate([p[0] for p in parts])]
            order = np.argsort(rows, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=b.num_rows))]).astype("i4")
            paths = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([p[1] for p in parts])[order].view("i8")))
            toks = [None] * b.num_rows
            for i, t in zip(at, tokens(low)):
                toks[i] = t.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(keys, pa.binary()), pa.array(toks, pa.binary()), paths],
                                             names=["doc_id", "key", "tokens", "paths"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, key binary, tokens binary, paths array<long>")


def runs_for(recall: float = TARGET_RECALL, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def split(node: np.ndarray, toks: np.ndarray):
    """(row, child bucket) of every slot the nodes choose: one slot, and in a quarter of the nodes a second."""
    with np.errstate(over="ignore"):
        a = (mix(node ^ U(0xA5A5A5A5)) % U(SLOTS)).astype("i8")
        b = (a + 1 + (mix(node ^ U(0x5A5A5A5A)) % U(SLOTS - 1)).astype("i8")) % SLOTS
        two = (mix(node ^ U(0x33333333)) >> U(32)) < U(int((1 / THRESHOLD - 1) * 2 ** 32))
        rows = np.concatenate([np.arange(len(node)), np.nonzero(two)[0]])
        slot = np.concatenate([a, b[two]])
        child = mix((node[rows] ^ mix(slot.astype("u8") * GOLD)) + toks[rows, slot].astype("u8") * GOLD + U(1))
    return rows, child


def _matrix(column, kind, width=None):
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=kind)
    return flat.reshape(len(column), -1 if width is None else width) if len(column) else flat.reshape(0, width or 0)


def next_paths(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            got, child = split(np.asarray(b.column("path")).view("u8"), _matrix(b.column("tokens"), "<u2", SLOTS))
            yield pa.RecordBatch.from_pydict({"path": child.view("i8"), "rep": np.asarray(b.column("rep"))[got]})

    return rows.select("path", "rep", "tokens").mapInArrow(run, "path long, rep long")


def leaves(sets: DataFrame, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """(path, rep, n): every bucket to brute-force with its sets; n sets in the bucket."""
    found, rows = None, sets.select("rep", F.explode("paths").alias("path"))
    for level in range(1, levels + 1):
        rows = materialize(rows, "join-paths").distinct() if level > 1 else rows
        n = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = materialize(rows.join(n, "path"), "join-buckets")
        here = rows if level == levels else rows.where(F.col("n") <= leaf)
        found = here if found is None else found.unionByName(here)
        large = rows.where(F.col("n") > leaf)
        if level == levels or not large.limit(1).count():
            break
        rows = next_paths(large.select("path", "rep").join(sets.select("rep", "tokens"), "rep"))
    return found


def tiles(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """Large buckets as tiles of two blocks: (path, ti, tj, side, rep). A set meets every block of its bucket once."""
    nb = F.when(F.col("n") <= 2 * block, F.lit(1)).otherwise(F.ceil(F.col("n") / block)).cast("int")
    own = F.pmod(F.xxhash64("rep", "path"), F.col("_nb")).cast("int")
    return (found.withColumn("_nb", nb).withColumn("side", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
            .select("path", F.least("side", "_other").alias("ti"), F.greatest("side", "_other").alias("tj"), "side", "rep"))


def _groups(batches):
    """Whole tiles from batches sorted by tile: tables of one or more complete tiles and their bounds."""
    held = []

    def parts(t):
        key = np.stack([np.asarray(t.column(c)).astype("i8") for c in ("path", "ti", "tj")])
        cut = np.nonzero((key[:, 1:] != key[:, :-1]).any(axis=0))[0] + 1
        return np.concatenate([[0], cut, [t.num_rows]]) if t.num_rows else np.array([0])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        last = [b.column(c)[b.num_rows - 1].as_py() for c in ("path", "ti", "tj")]
        first = [held[0].column(c)[0].as_py() for c in ("path", "ti", "tj")]
        if first == last:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        bounds = parts(t)
        yield t.slice(0, bounds[-2]).combine_chunks(), bounds[:-1]
        held = t.slice(bounds[-2]).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, parts(t)


def _all_pairs(bounds, side, ti, tj, small: int = 64):
    """Row pairs (i < j) of every tile, in portions; two blocks of one bucket give cross pairs only."""
    sizes = np.diff(bounds)
    for n in np.unique(sizes[(sizes > 1) & (sizes <= small)]):
        i, j = np.triu_indices(n, 1)
        starts = bounds[:-1][sizes == n]
        for at in range(0, len(starts), max(1, 200_000 // len(i))):
            s = starts[at:at + max(1, 200_000 // len(i)), None]
            yield (s + i).ravel(), (s + j).ravel()
    for g in np.nonzero(sizes > small)[0]:
        a, b = bounds[g], bounds[g + 1]
        step = max(1, 200_000 // (b - a))
        for r in range(a, b, step):
            i, j = np.meshgrid(np.arange(r, min(b, r + step)), np.arange(a, b), indexing="ij")
            keep = j > i
            yield i[keep], j[keep]


def _canonical(i, j, path, keys, width):
    """Pairs whose smallest common bucket is this one. keys: padded rows of ascending uint64, pad = all ones."""
    out = np.zeros(len(i), bool)
    step = max(1, 4_000_000 // (width * width))
    for at in range(0, len(i), step):
        a, b = keys[i[at:at + step]], keys[j[at:at + step]]
        common = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != U(2 ** 64 - 1))
        first = np.where(common, a, U(2 ** 64 - 1)).min(axis=1)
        out[at:at + step] = first == path[i[at:at + step]]
    return out


def _padded(column):
    lists = [np.frombuffer(x, "<u8") for x in column.to_pylist()]
    width = max(map(len, lists), default=1)
    out = np.full((len(lists), width), U(2 ** 64 - 1))
    for r, x in enumerate(lists):
        out[r, :len(x)] = x
    return out, width


def _cross(i, j, side, ti, tj):
    return (ti[i] == tj[i]) | (side[i] != side[j])


def screen(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The sets of each tile that are in some likely pair counted there: (path, ti, tj, side, rep, keys)."""
    least = math.floor(SLOTS * threshold - SCREEN_SIGMA * math.sqrt(SLOTS * threshold * (1 - threshold)))

    def run(batches):
        for t, bounds in _groups(batches):
            toks, (keys, width) = _matrix(t.column("tokens"), "<u2", SLOTS), _padded(t.column("keys"))
            path = np.asarray(t.column("path")).view("u8")
            side, ti, tj = (np.asarray(t.column(c)) for c in ("side", "ti", "tj"))
            need = np.zeros(t.num_rows, bool)
            for i, j in _all_pairs(bounds, side, ti, tj):
                ok = _cross(i, j, side, ti, tj)
                i, j = i[ok], j[ok]
                for at in range(0, len(i), 50_000):
                    x, y = i[at:at + 50_000], j[at:at + 50_000]
                    near = (toks[x] == toks[y]).sum(axis=1) >= least
                    x, y = x[near], y[near]
                    own = _canonical(x, y, path, keys, width)
                    need[x[own]] = True
                    need[y[own]] = True
            if need.any():
                yield from t.filter(pa.array(need)).select(["path", "ti", "tj", "side", "rep", "keys"]).combine_chunks().to_batches()

    return rows.mapInArrow(run, "path long, ti int, tj int, side int, rep long, keys binary")


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shared shingles."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    owner, at = owner[shared], at[shared]
    number = np.cumsum(count > 1) - 1
    at = number[at]
    total = int((count > 1).sum())
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((n, n), np.float32)
    for lo in range(0, total, columns):
        a, b = np.searchsorted(at, [lo, lo + columns])
        m = np.zeros((n, min(columns, total - lo)), np.float32)
        m[owner[a:b], at[a:b] - lo] = 1.0
        out += m @ m.T
    return out


def verify(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Exact links of each tile: (rep, links, low): links counted here, smallest id of the set's linked part of the tile."""
    def run(batches):
        for t, bounds in _groups(batches):
            keys, width = _padded(t.column("keys"))
            path = np.asarray(t.column("path")).view("u8")
            side, ti, tj, rep = (np.asarray(t.column(c)) for c in ("side", "ti", "tj", "rep"))
            shingles = [np.frombuffer(x, "<u8") for x in t.column("shingles").to_pylist()]
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a < 2:
                    continue
                size = np.array([len(s) for s in shingles[a:b]], np.float32)
                both = overlaps(shingles[a:b])
                i, j = np.nonzero(np.triu(both >= threshold * (size[:, None] + size[None, :] - both) - 1e-3, 1))
                i, j = i + a, j + a
                ok = _cross(i, j, side, ti, tj)
                i, j = i[ok], j[ok]
                own = _canonical(i, j, path, keys, width)
                i, j = i[own] - a, j[own] - a
                if not len(i):
                    continue
                links = np.bincount(i, minlength=b - a) + np.bincount(j, minlength=b - a)
                low = rep[a:b].copy()
                while True:                              # smallest id spreads along the links of the tile
                    before = low.copy()
                    np.minimum.at(low, i, before[j])
                    np.minimum.at(low, j, before[i])
                    if (low == before).all():
                        break
                has = links > 0
                out.append((rep[a:b][has], links[has], low[has]))
            if out:
                r, k, low = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_pydict({"rep": r, "links": k.astype("i8"), "low": low})

    return rows.mapInArrow(run, "rep long, links long, low long")


def shingled(docs: DataFrame) -> DataFrame:
    """(key, shingles) of every text."""
    def run(batches):
        shingle = Shingler()
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": pa.array([text_key(x) for x in texts], pa.binary()),
                                              "shingles": pa.array([shingle(x).tobytes() for x in texts], pa.binary())})

    return docs.select("text").mapInArrow(run, "key binary, shingles binary")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): smallest node of each connected part, for the nodes of ``edges`` (a, b).
    Alternating large and small stars; every round is written to the shared folder."""
    def star(pairs, small):
        both = pairs if small else pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.join(low, "a")
        if small:
            out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        else:
            out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where(F.col("a") != F.col("b")).distinct()

    def mark(pairs):
        r = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    pairs = materialize(pairs, "join-stars")
    seen = mark(pairs)
    while seen[0]:
        pairs = materialize(star(star(pairs, False), True), "join-stars")
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def linked_texts(marks: DataFrame, docs: DataFrame, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row a text class: key, rep (its smallest id), n_copies, n_links, root (one class of its group), of the
    documents with an id and a word. ``marks``: their written sketch."""
    # Exact copies: the class takes the sketch of a row of its smallest id (all are equal).
    classes = (marks.where("key is not null and doc_id is not null").groupBy("key")
               .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies")))
    names = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "join-classes")
    own = marks.join(names.select("key", "doc_id", "rep"), ["doc_id", "key"]).dropDuplicates(["rep"])
    sets = materialize(own.select("rep", "tokens", "paths"), "join-sets")
    found = materialize(tiles(leaves(sets, leaf), block), "join-tiles")
    keyed = found.groupBy("rep").agg(F.collect_set("path").alias("paths"))
    keyed = sets.select("rep", "tokens").join(keyed, "rep").select("rep", "tokens", "paths").mapInArrow(_sorted_keys, "rep long, tokens binary, keys binary")
    tile = ["path", "ti", "tj"]
    rows = found.join(keyed, "rep").repartition(*tile).sortWithinPartitions(*tile)
    likely = materialize(screen(rows), "join-likely")
    wanted = names.select("rep", "key", "doc_id").join(likely.select("rep").distinct(), "rep", "left_semi")
    wanted = materialize(wanted, "join-ids")
    # Ids of at most MAX_BROADCAST_IDS sets (8 MB) are broadcast to the scan; more go through a shuffle join.
    ids = wanted.select("doc_id").distinct()
    ids = F.broadcast(ids) if wanted.count() <= MAX_BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    # Repeated rows of one id and text give a class once.
    full = wanted.select("rep", "key").join(shingled(texts), "key").groupBy("rep").agg(F.min("shingles").alias("shingles"))
    linked = materialize(verify(likely.join(full, "rep").repartition(*tile).sortWithinPartitions(*tile, "rep")), "join-links")
    n_links = linked.groupBy("rep").agg(F.sum("links").alias("n_links"))
    roots = components(linked.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    return (names.join(n_links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("key", F.col("doc_id").alias("rep"), "n_copies", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("root", "rep").alias("root")))


def near_duplicates(docs: DataFrame, recall: float = TARGET_RECALL, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, text_id, n_copies, n_links for every document."""
    marks = materialize(sketch(docs, runs_for(recall)), "join-sketch")
    texts = materialize(linked_texts(marks, docs, leaf, block), "join-texts")
    least = texts.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = texts.join(least, "root").select("key", "class_id", F.col("rep").alias("text_id"), "n_copies", "n_links")
    with_key = join_per_key(marks.select("doc_id", "key").where("key is not null and doc_id is not null"), named, ["key"], "inner")
    alone = marks.where("key is null or doc_id is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return with_key.select("doc_id", "class_id", "text_id", "n_copies", "n_links").unionByName(alone)


def distinct_documents(docs: DataFrame, recall: float = TARGET_RECALL) -> DataFrame:
    """One row of every group of linked texts: that of the smallest id (of its texts, the one of smallest key). Rows
    without an id or without a word all stay. Columns as in ``docs``."""
    marks = materialize(sketch(docs, runs_for(recall)), "join-sketch")
    texts = linked_texts(marks, docs)
    kept = materialize(texts.groupBy("root").agg(F.min(F.struct("rep", "key")).alias("k")).select("k.*"), "join-kept")
    # The whole row travels as one column, so no column of the documents can clash.
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text", F.struct("*").alias("doc"))

    def keys(batches):
        for b in batches:
            found = [text_key(x) if x and x.split() else None for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array(found, pa.binary()), b.column("doc")], names=["rep", "key", "doc"])

    kind = rows.schema["doc"].dataType.simpleString()
    rows = rows.mapInArrow(keys, f"rep long, key binary, doc {kind}")
    first = rows.where("rep is not null and key is not null").join(kept, ["rep", "key"], "left_semi").dropDuplicates(["rep", "key"])
    rest = rows.where("rep is null or key is null")
    return first.unionByName(rest).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _sorted_keys(batches):
    """(rep, tokens, paths) -> the paths as ascending unsigned 64-bit keys in bytes."""
    for b in batches:
        keys = [np.sort(np.array(p, "i8").view("u8")).astype("<u8").tobytes() for p in b.column("paths").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("tokens"), pa.array(keys, pa.binary())], names=["rep", "tokens", "keys"])
