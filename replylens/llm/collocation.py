"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at sentence marks and line breaks, and
pieces into words. Phrases never cross a piece. Everything is counted per language.

1. Level by level (1 to ``MAX_WORDS`` words) numpy prefix polynomials fingerprint
   every phrase (``textscan``); a task adds up its fingerprints and the shuffle adds
   up the tasks'. No phrase text is shuffled: a row is (fingerprint, occurrences) and, of
   frequent ones, least and greatest check value and a pointer to a document that holds it.
2. A phrase can reach ``MIN_COUNT`` only if both phrases of one word less did. The
   frequent fingerprints of a level become a bit table of at most ``TABLE_BITS``
   bits (its size is fixed, so it may be broadcast whatever the data); the next
   scan counts only what passes it, and finds check values and pointers of the
   frequent phrases of the level before, so rare phrases cost 16 bytes. The table has no false negatives, so nothing
   frequent is lost; when it fills up it merely prunes less.
3. Collisions: every occurrence also has a second, independent fingerprint. Where the
   least and greatest differ, or the document pointed to shows two texts, the
   occurrences are counted again by their text.
4. Only frequent phrases are materialised: the documents pointed to are scanned
   again and give the text of the fingerprints looked for.
5. Scores, containment and ranks are joins over the frequent phrases.

Score of a phrase of f = a: over its cuts into two parts with counts l and r the least
floor(2000000 a / (l + r)), in decimal arithmetic. A phrase inside a longer frequent
one that occurs at least 80 % as often is dropped.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count as
often as they stand; an empty table gives no rows; ids may be null or repeat; extra
columns are ignored. Words may be of any length; a text is scanned whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize
from .textscan import Scanner, bitmix, byte_set, slices

BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
COVERED = 80                         # per cent of a phrase's count at which a longer phrase covers it
SCALE = 2_000_000
TABLE_BITS = 1 << 27                 # 16 MB: bound of what is broadcast
BLOCK_BITS = 1 << 19
HELD = 100_000                       # fingerprints a task holds before it hands them on
SLICE = 1 << 18                      # bytes of texts scanned together
COUNTS = "n int, fp long, a long, low long, high long, locator long"
U = np.uint64


class Phrases:
    """Fingerprints of the phrases of a slice of texts. ``bits`` < 64 weakens the first fingerprint (tests)."""

    def __init__(self, bits: int = 64):
        word = ~byte_set(BREAKS + SPACES)
        self.first, self.second, self.cut = Scanner(word, 1), Scanner(word, 2), byte_set(BREAKS)
        self.mask = U((1 << bits) - 1)

    def words(self, s):
        """(start, end, owner, piece, hashes, second hashes) of the words."""
        start, end, h = self.first.find(s.data)
        piece = np.cumsum(self.cut[s.data], dtype="i4")[start]
        return start, end, s.owner(start), piece, h, self.second.find(s.data)[2]

    def phrases(self, words, n: int, salt: np.ndarray):
        """Places, fingerprints and check values of the n-word phrases; ``salt``: a value per text (its language)."""
        start, end, owner, piece, h, g = words
        at = np.flatnonzero(piece[:max(0, len(piece) - n + 1)] == piece[n - 1:]) if len(piece) >= n else np.empty(0, "i8")
        own = salt[owner[at]]
        fp = bitmix(self.first.sequences(h, n)[at] ^ own) & self.mask if len(at) else np.empty(0, "u8")
        check = bitmix(self.second.sequences(g, n)[at] + own) if len(at) else np.empty(0, "u8")
        return at, fp, check


def _probes(fp: np.ndarray, bits: int):
    return (fp & U(bits - 1)).astype("i8"), (bitmix(fp + U(0x9E3779B97F4A7C15)) & U(bits - 1)).astype("i8")


def passes(table: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Which fingerprints the bit table holds (never false for one that was put in)."""
    a, b = _probes(fp, len(table) * 8)
    return ((table[a >> 3] >> (a & 7).astype("u1")) & (table[b >> 3] >> (b & 7).astype("u1")) & 1).astype(bool)


def bit_table(fps: DataFrame, most: int = TABLE_BITS) -> np.ndarray:
    """Bit table of the fingerprints (column fp). Blocks of bits are set by one task each; the driver gets the
    table alone: 16 bits a fingerprint, at most ``most`` bits."""
    bits = 1 << 13
    while bits < most and bits < 16 * fps.count():
        bits <<= 1
    block = min(bits, BLOCK_BITS)

    def place(batches):
        for b in batches:
            for p in _probes(np.asarray(b.column("fp")).view("u8"), bits):
                yield pa.RecordBatch.from_pydict({"block": (p // block).astype("i4"), "bit": (p % block).astype("i4")})

    def fill(batches):
        found = {}
        for b in batches:
            blocks, places = np.asarray(b.column("block")), np.asarray(b.column("bit"))
            for k in np.unique(blocks):
                flags = found.setdefault(int(k), np.zeros(block, bool))
                flags[places[blocks == k]] = True
        for k, flags in found.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()),
                                              "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    rows = fps.select("fp").mapInArrow(place, "block int, bit int").repartition("block").mapInArrow(fill, "block int, bits binary")
    table = np.zeros(bits // 8, "u1")
    for r in rows.collect():
        table[r["block"] * block // 8:(r["block"] + 1) * block // 8] = np.frombuffer(r["bits"], "u1")
    return table


class Sums:
    """Adds up rows (fp, then one array for each way of adding) by fp; hands them on when many are held."""

    def __init__(self, *ways):
        self.ways, self.parts, self.size = ways, [], 0

    def add(self, *arrays):
        """Sums to hand on now (or None)."""
        self.parts.append(arrays)
        self.size += len(arrays[0])
        if self.size <= 2 * HELD:
            return None
        self.parts = [self.total()]
        self.size = len(self.parts[0][0])
        return self.take() if self.size > HELD else None

    def total(self):
        fp, *rest = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(fp, kind="stable")
        fp = fp[order]
        cut = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.empty(0, "i8")
        return fp[cut], *(way.reduceat(x[order], cut) if len(cut) else x for way, x in zip(self.ways, rest))

    def take(self):
        out, self.parts, self.size = self.total() if self.parts else None, [], 0
        return out if out is not None and len(out[0]) else None


def count_level(docs: DataFrame, n: int, most: int, table=None, min_count: int = MIN_COUNT, bits: int = 64) -> DataFrame:
    """One scan (COUNTS): the n-word fingerprints that may be frequent with their occurrences (none when n > ``most``), and
    the frequent ones of one word less with check values and pointer. Level 1 has the words per language too,
    as rows of n = 0."""
    def rows(k, fp, a, *more):
        none = pa.nulls(len(fp), pa.int64())
        low, high, loc = more or (none, none, none)
        return pa.RecordBatch.from_pydict({"n": np.full(len(fp), k, "i4"), "fp": fp.view("i8"), "a": a.astype("i8"),
                                           "low": low, "high": high, "locator": loc})

    def run(batches):
        scan, totals = Phrases(bits), {}
        counts, shown = Sums(np.add), Sums(np.add, np.minimum, np.maximum, np.minimum)
        shorter = None if table is None else table.value
        for b in batches:
            lang, locator = (np.asarray(b.column(c)) for c in ("lang_key", "locator"))
            for s in slices(b.column("text"), SLICE):
                salt, loc = lang[s.rows.start:s.rows.stop], locator[s.rows.start:s.rows.stop]
                words = scan.words(s)
                if n == 1:
                    for key, c in zip(*np.unique(salt[words[2]], return_counts=True)):
                        totals[int(key)] = totals.get(int(key), 0) + int(c)
                else:
                    where, part, check = scan.phrases(words, n - 1, salt.view("u8"))
                    ok = passes(shorter, part)
                    where, part, check = where[ok], part[ok], check[ok].view("i8")    # signed, as Spark compares them
                    out = shown.add(part, np.ones(len(part), "i8"), check, check, loc[words[2][where]])
                    if out:
                        yield rows(n - 1, *out)
                if n <= most:
                    at, fp, _ = scan.phrases(words, n, salt.view("u8"))
                    if n > 1:
                        good = np.zeros(len(words[0]) + 1, bool)
                        good[where] = True
                        fp = fp[good[at] & good[at + 1]]
                    out = counts.add(fp, np.ones(len(fp), "i8"))
                    if out:
                        yield rows(n, *out)
        for k, left in ((n, counts.take()), (n - 1, shown.take())):
            if left:
                yield rows(k, *left)
        if totals:
            yield rows(0, np.array(list(totals), "i8"), np.array(list(totals.values()), "i8"))

    found = docs.select("text", "lang_key", "locator").mapInArrow(run, COUNTS)
    found = found.groupBy("n", "fp").agg(F.sum("a").alias("a"), F.min("low").alias("low"), F.max("high").alias("high"),
                                         F.min("locator").alias("locator"))
    return found.where((F.col("a") >= min_count) | (F.col("n") == 0))


def _texts(docs: DataFrame, wanted: str, max_words: int, bits: int) -> DataFrame:
    """(lang, fp, n, phrase, a): the phrases of every text whose fingerprints are in its list ``wanted``, with their
    occurrences in the text."""
    def run(batches):
        scan = Phrases(bits)
        for b in batches:
            lang, langs, lists = np.asarray(b.column("lang_key")), b.column("lang"), b.column(wanted)
            for s in slices(b.column("text"), SLICE):
                salt, words = lang[s.rows.start:s.rows.stop].view("u8"), scan.words(s)
                data = s.data.tobytes()
                look = [np.sort(np.asarray(lists[i].values).view("u8")) for i in s.rows]
                out = {}
                for n in range(1, max_words + 1):
                    at, fp, _ = scan.phrases(words, n, salt)
                    owner = words[2][at]
                    ends = np.searchsorted(owner, np.arange(len(look) + 1))
                    for d, seek in enumerate(look):
                        part = fp[ends[d]:ends[d + 1]]
                        for j in ends[d] + np.flatnonzero(np.isin(part, seek)):
                            i = at[j]
                            text = b" ".join(data[words[0][x]:words[1][x]] for x in range(i, i + n)).lower().decode("utf-8", "replace")
                            key = (langs[s.rows[d]].as_py(), int(fp[j].view("i8")), n, text)
                            out[key] = out.get(key, 0) + 1
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_pydict({"lang": pa.array(cols[0], pa.string()), "fp": pa.array(cols[1], pa.int64()),
                                                      "n": pa.array(cols[2], pa.int32()), "phrase": pa.array(cols[3], pa.string()),
                                                      "a": pa.array(list(out.values()), pa.int64())})

    return docs.select("text", "lang", "lang_key", wanted).mapInArrow(run, "lang string, fp long, n int, phrase string, a long")


def _recounted(docs: DataFrame, odd: DataFrame, max_words: int, min_count: int, bits: int) -> DataFrame:
    """Exact counts by text of all phrases whose fingerprint is among ``odd`` (n, fp): found through the bit table,
    then joined; phrases are added up by their text."""
    table = docs.sparkSession.sparkContext.broadcast(bit_table(odd))

    def run(batches):
        scan = Phrases(bits)
        for b in batches:
            lang, langs = np.asarray(b.column("lang_key")), b.column("lang")
            for s in slices(b.column("text"), SLICE):
                salt, words = lang[s.rows.start:s.rows.stop].view("u8"), scan.words(s)
                data, out = s.data.tobytes(), {}
                for n in range(1, max_words + 1):
                    at, fp, _ = scan.phrases(words, n, salt)
                    for j in np.flatnonzero(passes(table.value, fp)):
                        i = at[j]
                        text = b" ".join(data[words[0][x]:words[1][x]] for x in range(i, i + n)).lower().decode("utf-8", "replace")
                        key = (langs[s.rows[int(words[2][i])]].as_py(), int(fp[j].view("i8")), n, text)
                        out[key] = out.get(key, 0) + 1
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_pydict({"lang": pa.array(cols[0], pa.string()), "fp": pa.array(cols[1], pa.int64()),
                                                      "n": pa.array(cols[2], pa.int32()), "phrase": pa.array(cols[3], pa.string()),
                                                      "a": pa.array(list(out.values()), pa.int64())})

    seen = docs.select("text", "lang", "lang_key").mapInArrow(run, "lang string, fp long, n int, phrase string, a long")
    seen = seen.groupBy("lang", "fp", "n", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    return seen.join(odd, ["n", "fp"], "left_semi").select("lang", "n", "phrase", "a")


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, bits: int = 64):
    """(phrases: lang, n, phrase, a; totals: lang, n_words) of all phrases of 1 to ``max_words`` words."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    docs = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("lang_key"),
                       F.xxhash64(F.col("doc_id").cast("string"), lang, "text").alias("locator")).where("text is not null")
    found = totals = table = None
    for n in range(1, max_words + 2):
        level = materialize(count_level(docs, n, max_words, table, min_count, bits), "phrases-level")
        if n == 1:
            totals = (level.where("n = 0").select(F.col("fp").alias("lang_key"), F.col("a").alias("n_words"))
                      .join(docs.select("lang", "lang_key").distinct(), "lang_key").select("lang", "n_words"))
        else:
            shown = level.where(F.col("n") == n - 1)
            found = shown if found is None else found.unionByName(shown)
        own = level.where(F.col("n") == n)
        if n == 1 or own.limit(1).count():
            table = spark.sparkContext.broadcast(bit_table(own))
        else:
            break
    # A phrase points to its document of least hash, so few documents are pointed to: a bit table finds them in the scan,
    # and only their texts are shuffled.
    wanted = materialize(found.where("low = high").groupBy("locator").agg(F.collect_set("fp").alias("fps")), "phrases-wanted")
    shared = spark.sparkContext.broadcast(bit_table(wanted.select(F.col("locator").alias("fp"))))

    def pointed(batches):
        for b in batches:
            yield b.filter(pa.array(passes(shared.value, np.asarray(b.column("locator")).view("u8"))))

    texts = docs.select("text", "lang", "lang_key", "locator").mapInArrow(pointed, "text string, lang string, lang_key long, locator long")
    shown = _texts(texts.join(wanted, "locator"), "fps", max_words, bits).select("lang", "fp", "n", "phrase").distinct()
    shown = materialize(shown.join(found.where("low = high").select("n", "fp", "a"), ["n", "fp"]), "phrases-shown")
    # One text a fingerprint, or the fingerprint is counted again by text.
    double = shown.groupBy("n", "fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("n", "fp")
    odd = materialize(found.where("low != high").select("n", "fp").unionByName(double), "phrases-odd")
    phrases = shown.select("lang", "n", "phrase", "a")
    if odd.limit(1).count():
        phrases = (shown.join(odd, ["n", "fp"], "left_anti").select("lang", "n", "phrase", "a")
                   .unionByName(_recounted(docs, odd, max_words, min_count, bits)))
    return materialize(phrases, "phrases"), totals


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n (words of the language), score: the best ``top`` phrases of each language."""
    phrases, totals = frequent_phrases(docs, max_words, min_count, bits)
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    words = F.split("phrase", " ", -1)
    cuts = (phrases.where("n >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .withColumn("head", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
            .withColumn("tail", F.array_join(F.slice(words, F.col("k") + 1, F.col("n") - F.col("k")), " ")))
    cuts = (cuts.join(parts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"])
            .join(parts.withColumnsRenamed({"part": "tail", "f": "r"}), ["lang", "tail"])
            .withColumn("score", F.expr(f"(cast({SCALE} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.explode(F.expr("filter(flatten(transform(sequence(2, n - 1), k -> transform(sequence(1, n - k + 1), i -> "
                             "array_join(slice(split(phrase, ' ', -1), i, k), ' ')))), x -> x is not null)"))
    longer = (phrases.where("n >= 3").select("lang", inner.alias("phrase"), F.col("a").alias("f"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("f")))
    kept = (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("f").isNull() | (F.col("f").cast("decimal(22,0)") * 100 < F.col("a").cast("decimal(22,0)") * COVERED))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (ranked.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score"))
