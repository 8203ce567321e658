"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (1 to 3
characters of lower-cased words padded with a blank on either side), in order of
frequency. A document's own list is compared with each profile by the
out-of-place distance: the sum over its n-grams of how far their ranks differ,
and ``PROFILE`` for one the profile lacks.

Words are counted first and only distinct words are cut into n-grams, so the
counts cover whole texts at little cost. Training counts are summed per task and
language before they are shuffled; the driver receives ``PROFILE`` n-grams for
each language. Equal counts are ordered by n-gram code, so results do not depend
on the partitioning.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without any training text every text is ``und``; equal distances go to the first
language by name; repeated rows are scored as rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

PROFILE = 400
FLUSH = 200_000                  # distinct words of a language a worker holds before it passes their counts on
# A text whose best distance is above this share of the largest is like none of the languages.
REJECT_ABOVE = 0.98
LETTERS = re.compile(r"[^\W\d_]+")


def gram_counts(words: Counter):
    """(codes ascending, counts) of the 1- to 3-grams (21 bits a character) of a bag of words, each padded with a
    blank on either side; the pad alone is none. The distinct words are laid out as one text and cut at once."""
    c = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    times, size = np.fromiter(words.values(), "i8", len(words)), np.fromiter(map(len, words), "i8", len(words))
    w = np.concatenate([[0], np.repeat(times, size + 1)])          # a character counts as often as its word
    inner = c != 32
    mid = inner[1:-1]                                              # a blank in the middle would join two words
    codes = np.concatenate([c[inner], (c[:-1] << 21) | c[1:], ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[mid]])
    weight = np.concatenate([w[inner], np.where(inner[:-1], w[:-1], w[1:]), w[1:-1][mid]])
    order = np.argsort(codes, kind="stable")
    codes, weight = codes[order], weight[order]
    first = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
    return codes[first], np.add.reduceat(weight, first)


def train(docs: DataFrame, lang: Column, profile: int = PROFILE) -> list[tuple[str, int, int]]:
    """(lang, n-gram code, rank from 0) of every language's profile, from all rows of ``docs``."""
    def count(batches):
        held = {}
        for b in batches:
            for text, name in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                words = held.setdefault(name, Counter())
                words.update(LETTERS.findall(text.lower()))
                if len(words) > FLUSH:
                    yield emit(name, held.pop(name))
        for name, words in held.items():
            if words:
                yield emit(name, words)

    def emit(name, words):
        codes, n = gram_counts(words)
        return pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(codes), pa.string()), "gram": codes, "n": n})

    rows = docs.select(F.col("text"), lang.alias("lang")).where("text is not null and lang is not null")
    total = (rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = total.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < profile)
    return [(r["lang"], r["gram"], r["rank"]) for r in best.collect()]


def rank_table(profiles, size: int = PROFILE):
    """Languages (sorted), n-gram codes (ascending) and the rank of each code in each language (``size``: absent)."""
    langs = sorted({p[0] for p in profiles})
    codes = np.array(sorted({p[1] for p in profiles}), dtype="i8")
    ranks = np.full((len(codes), len(langs)), size, dtype="i8")
    for name, code, rank in profiles:
        ranks[np.searchsorted(codes, code), langs.index(name)] = rank
    return langs, codes, ranks


def distances(words: Counter, codes: np.ndarray, ranks: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """Out-of-place distance of a bag of words to every language, as a share of the largest possible."""
    own, n = gram_counts(words)
    if len(n) > size:                                  # only these can be among the most frequent
        keep = n >= np.partition(n, len(n) - size)[len(n) - size]
        own, n = own[keep], n[keep]
    top = own[np.argsort(-n, kind="stable")][:size]    # codes ascend, so equal counts are in code order
    at = np.minimum(np.searchsorted(codes, top), len(codes) - 1)
    known = codes[at] == top
    there = np.where(known[:, None], ranks[at], size)
    place = np.arange(len(top))[:, None]
    return np.where(there == size, size, np.abs(there - place)).sum(0) / (size * len(top))


RESULT = ("lang_pred", "score", "distance", "rejected")


def predict(docs: DataFrame, profiles, extra: list[str], size: int = PROFILE, reject_above: float = REJECT_ABOVE,
            names: tuple[str, ...] = RESULT) -> DataFrame:
    """``extra`` columns + lang_pred, score (1 - best distance / second best, 0..1), distance (share of the largest)
    and rejected (no letter, or like none of the languages), under the given ``names``."""
    langs, codes, ranks = rank_table(profiles, size)

    def score(batches):
        for b in batches:
            pred, conf, dist = [], [], []
            for text in b.column("text").to_pylist():
                words = Counter(LETTERS.findall(text.lower())) if text and langs else None
                if not words:
                    pred.append("und"), conf.append(0.0), dist.append(1.0)
                    continue
                d = distances(words, codes, ranks, size)
                best = int(np.argmin(d))
                rest = np.delete(d, best).min() if len(langs) > 1 else 1.0
                pred.append(langs[best]), dist.append(float(d[best]))
                conf.append(float(min(1.0, max(0.0, 1 - d[best] / rest))) if rest > 0 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in extra], pa.array(pred, pa.string()), pa.array(conf, pa.float64()),
                 pa.array(dist, pa.float64()), pa.array([p == "und" or x > reject_above for p, x in zip(pred, dist)])],
                names=[*extra, *names])

    rows = docs.select(*dict.fromkeys([*extra, "text"]))
    kept = [f for f in rows.schema.fields if f.name in extra]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted(kept, key=lambda f: extra.index(f.name)))
    new = ", ".join(f"`{n}` {t}" for n, t in zip(names, ("string", "double", "double", "boolean")))
    return rows.mapInArrow(score, f"{kinds}, {new}")
