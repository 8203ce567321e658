"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents carry a label; all others are unlabelled, some of
them toxic. With class prior p and losses l(+), l(-) the risk is

    p * E_pos[l(+)] + max(0, E_unl[l(-)] - p * E_pos[l(-)])

The difference estimates the risk on clean texts; where it falls below zero (by
more than the small ``SLACK`` of a sampled estimate) a short step goes the other
way (the non-negative correction). Linear models on the
presence of words and of word beginnings (4 and 5 letters, for inflected forms)
are trained by Adam in numpy, at least ``MODELS`` of them, and their logits are averaged. Features are those that toxic rows hold clearly
more often than the others, by counts over all learning rows.

The toxic rows learned from are at most ``MAX_POSITIVE`` (documented bound on labelled
rows, by seeded hash of the id), their ``CANDIDATES`` most frequent codes are looked at.
The unlabelled rows are all rows of the learning folds: one scan writes which
candidates each holds, the rows are dealt into shards of about ``SHARD_ROWS`` by hash, every
shard estimates the risk over all its rows against all toxic rows and fits its models,
and the models are averaged by rows. The driver gets candidate counts, the toxic
rows' features as bits, and the average. The prior is the share of toxic rows
among all labelled rows of the learning folds, but not more than the unlabelled rows
can hold: a feature is at most as frequent there as p times its share in toxic rows allows.

Defined cases: null and empty texts score the bias alone; without toxic rows
every score is the prior; repeated rows are scored as rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_ids, materialize

MAX_POSITIVE = 4_000
CANDIDATES = 1 << 16
SHARD_ROWS = 8_192
FEATURES = 2_048
MIN_GAIN = 5.0                  # log-likelihood ratio a feature needs
MIN_POSITIVE_DOCS = 3
STEPS = 250
SLACK = 0.02
STEP_BACK = 0.3
MODELS = 3
CACHE = 500_000                  # words a worker remembers at most
WORD = re.compile(r"[^\W_]+")


def word_codes(word: str) -> tuple[int, ...]:
    """Feature codes of a word: itself and its beginnings."""
    forms = ["w" + word, *(f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n)]
    return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in forms)


def presence(docs: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` + the sorted codes of a text's features, as bytes."""
    def codes(batches):
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                found = {c for w in set(WORD.findall((text or "").lower())) for c in word_codes(w)}
                out.append(np.sort(np.fromiter(found, "<u4", len(found))).tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in extra], pa.array(out, pa.binary())], names=[*extra, "codes"])

    rows = docs.select(*extra, "text")
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(codes, f"{kinds}, codes binary")


def best_codes(codes: np.ndarray, n: np.ndarray, m: np.ndarray, n_pos: int, n_unl: int, size: int = FEATURES) -> np.ndarray:
    """Codes (ascending) held more often by toxic rows (n of n_pos) than by the others (m of n_unl), by log-likelihood ratio."""
    keep = n >= MIN_POSITIVE_DOCS
    codes, n, m = codes[keep], n[keep], m[keep]

    def side(k, total, share):
        k = np.maximum(k, 1e-9)
        return k * np.log(k / total / share) + (total - k) * np.log(np.maximum(1 - k / total, 1e-12) / np.maximum(1 - share, 1e-12))

    n_pos, n_unl = max(1, n_pos), max(1, n_unl)
    share = (n + m + 0.5) / (n_pos + n_unl + 1)
    gain = np.where(n / n_pos > m / n_unl, side(n, n_pos, share) + side(m, n_unl, share), 0.0)
    first = np.lexsort((codes, -gain))[:size]
    return np.sort(codes[first[gain[first] >= MIN_GAIN]])


def design(rows: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    """0/1 matrix, a row for each document."""
    x = np.zeros((len(rows), len(features)), np.float32)
    for i, r in enumerate(rows):
        if len(features) and len(r):
            at = np.minimum(np.searchsorted(features, r), len(features) - 1)
            x[i, at[features[at] == r]] = 1.0
    return x


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def slopes(zp: np.ndarray, zu: np.ndarray, prior: float):
    """Slopes of the loss to go down, by the logits of the toxic and of the unlabelled rows: of the whole risk, or, where
    the estimate of the clean risk is negative, a part of the way up that estimate."""
    clean_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    # d l(+)/dz = sigmoid(z) - 1, d l(-)/dz = sigmoid(z).
    gp, gu = sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
    if clean_risk >= -SLACK:
        return np.full(len(zp), -prior / len(zp)), gu                 # p * (l(+)' - l(-)') is constant
    return STEP_BACK * prior * gp, -STEP_BACK * gu


def nnpu_fit(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = STEPS, lr: float = 0.05, l2: float = 1e-5):
    """Weights and bias of a linear model under the non-negative risk with logistic loss (Adam on whole samples:
    the difference of two risks is too noisy on small batches)."""
    w, b = np.zeros(xp.shape[1], np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for t in range(1, steps + 1):
        dp, du = slopes(xp @ w + b, xu @ w + b, prior)
        g = np.append(xp.T @ dp.astype(np.float32) + xu.T @ du.astype(np.float32) + l2 * w, dp.sum() + du.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w.astype(float), float(b)


def held_prior(n: np.ndarray, m: np.ndarray, n_pos: int, n_unl: int, prior: float, least: int = 20) -> float:
    """The prior cut to what the features frequent in toxic rows say: the median of their share in the
    unlabelled rows over their share in toxic rows."""
    top = np.argsort(-n, kind="stable")[:least]
    top = top[n[top] >= MIN_POSITIVE_DOCS]
    return float(min(prior, np.median((m[top] + 0.5) / n_unl / (n[top] / n_pos)))) if len(top) else prior


def fit(xp: np.ndarray, xu: np.ndarray, prior: float, models: int = MODELS):
    """Weights and bias: the average of ``models`` fits, each on all toxic rows and, if there are several, two thirds of the others."""
    got = []
    for seed in range(models):
        draw = np.random.default_rng(100 + seed).permutation(len(xu))[: max(1, len(xu) * 2 // 3)] if models > 1 else slice(None)
        got.append(nnpu_fit(xp, xu[draw], prior))
    return np.mean([g[0] for g in got], axis=0), float(np.mean([g[1] for g in got]))


def _candidates(docs: DataFrame, pos_ids: DataFrame) -> np.ndarray:
    """Ascending codes of the toxic rows, the most frequent CANDIDATES of those in MIN_POSITIVE_DOCS rows or more."""
    def count(batches):
        for b in batches:
            codes = [np.frombuffer(c, "<u4") for c in b.column("codes").to_pylist()]
            code, n = np.unique(np.concatenate([*codes, np.empty(0, "<u4")]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"code": code.astype("i8"), "n": n.astype("i8")})

    rows = presence(docs.join(F.broadcast(pos_ids), "doc_id", "left_semi"), ["doc_id"]).mapInArrow(count, "code long, n long")
    rows = rows.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_POSITIVE_DOCS)
    top = rows.orderBy(F.col("n").desc(), "code").limit(CANDIDATES).select("code").collect()
    return np.sort(np.array([r["code"] for r in top], "u4"))


def _held_candidates(rows: DataFrame, codes: np.ndarray) -> DataFrame:
    """h, is_pos and the numbers (in bytes) of the candidates that a text holds."""
    number = dict(zip(codes.tolist(), range(len(codes))))

    def run(batches):
        known = {}
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                found = set()
                for w in set(WORD.findall(text.lower())) if text else ():
                    x = known.get(w)
                    if x is None:
                        if len(known) >= CACHE:
                            known.clear()
                        x = known[w] = tuple(number[c] for c in word_codes(w) if c in number)
                    if x:
                        found.update(x)
                out.append(np.sort(np.fromiter(found, "<u2", len(found))).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("is_pos"), pa.array(out, pa.binary())], names=["h", "is_pos", "held"])

    return rows.select("h", "is_pos", "text").mapInArrow(run, "h long, is_pos boolean, held binary")


def _counts(rows: DataFrame, size: int):
    """Of every candidate the toxic rows and all rows that hold it, and the numbers of toxic and of all rows."""
    def run(batches):
        n, m, total = np.zeros(size, "i8"), np.zeros(size, "i8"), [0, 0]
        for b in batches:
            for pos, held in zip(b.column("is_pos").to_pylist(), b.column("held").to_pylist()):
                at = np.frombuffer(held, "<u2")
                m[at] += 1
                total[1] += 1
                if pos:
                    n[at] += 1
                    total[0] += 1
        some = np.flatnonzero(m)
        yield pa.RecordBatch.from_pydict({"at": np.append(some, -1).astype("i4"), "n": np.append(n[some], total[0]), "m": np.append(m[some], total[1])})

    n, m, total = np.zeros(size, "i8"), np.zeros(size, "i8"), (0, 0)
    sums = rows.select("is_pos", "held").mapInArrow(run, "at int, n long, m long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    for r in sums.collect():                              # one row a candidate
        if r["at"] < 0:
            total = r["n"], r["m"]
        else:
            n[r["at"]], m[r["at"]] = r["n"], r["m"]
    return n, m, *total


def train(docs: DataFrame, labels: DataFrame, learn, max_positive: int = MAX_POSITIVE, shard_rows: int = SHARD_ROWS):
    """(feature codes, weights, bias). ``learn``: function of an id column, true where labels may be learned from."""
    known = labels.where(learn(F.col("doc_id")) & F.col("toxic").isNotNull())
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    prior = (counts["t"] or 0) / counts["n"] if counts["n"] else 0.0
    prior = min(max(prior, 1e-3), 0.5)
    alone = np.empty(0, "u4"), np.zeros(0), float(np.log(prior / (1 - prior)))
    # At most max_positive ids: a broadcast with a fixed bound.
    pos_ids = bounded_ids(known.where("toxic = 1"), "doc_id", max_positive, "tox-p")
    codes = _candidates(docs, pos_ids)
    if not len(codes):
        return alone
    rows = docs.where(learn(F.col("doc_id"))).join(F.broadcast(pos_ids.withColumn("is_pos", F.lit(True))), "doc_id", "left")
    rows = rows.select(F.xxhash64("doc_id", "text").alias("h"), F.coalesce("is_pos", F.lit(False)).alias("is_pos"), "text")
    rows = materialize(_held_candidates(rows, codes), "toxicity-held")
    n, m, n_pos, n_unl = _counts(rows, len(codes))
    features = best_codes(np.arange(len(codes)), n, m, n_pos, n_unl)
    if not len(features) or not n_pos:
        return alone
    prior = max(1e-3, held_prior(n[features], m[features], n_pos, n_unl, prior))

    def held(row) -> np.ndarray:
        return np.frombuffer(row, "<u2").astype("i8")

    def bits(batches):
        for b in batches:
            x = np.packbits(design([held(r) for r in b.column("held").to_pylist()], features).astype(bool), axis=1)
            yield pa.RecordBatch.from_pydict({"x": pa.array([r.tobytes() for r in x], pa.binary())})

    got = rows.where("is_pos").orderBy("h", "held").limit(max_positive).select("held").mapInArrow(bits, "x binary").collect()
    n_rows, packed = len(got), b"".join(sorted(bytes(r["x"]) for r in got))       # at most 256 bytes a toxic row
    shards = max(1, -(-n_unl // shard_rows))
    models = max(1, -(-MODELS // shards))

    def learn_shard(table):
        xp = np.unpackbits(np.frombuffer(packed, "u1").reshape(n_rows, -1), axis=1, count=len(features)).astype(np.float32)
        table = table.sort_by([("h", "ascending"), ("held", "ascending")])
        w, b = fit(xp, design([held(r) for r in table.column("held").to_pylist()], features), prior, models)
        return pa.table({"at": pa.array(np.arange(-1, len(w)), pa.int32()), "w": np.append(b, w) * table.num_rows, "n": np.full(len(w) + 1, table.num_rows)})

    dealt = rows.select(F.pmod("h", F.lit(shards)).alias("shard"), "h", "held")
    fits = dealt.groupBy("shard").applyInArrow(learn_shard, "at int, w double, n long")
    average = {r["at"]: r["w"] / r["n"] for r in fits.groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect()}
    w = np.round([average[i] for i in range(-1, len(features))], 9)      # sums of floats come in any order
    return codes[features], w[1:], float(w[0])


def score(docs: DataFrame, model, extra: list[str], threshold: float = 0.7) -> DataFrame:
    """``extra`` + score (0..1) and predicted (score >= threshold) for every whole text."""
    features, weights, bias = model
    weight = dict(zip(map(int, features), map(float, weights)))

    def run(batches):
        known = {}                                     # word -> the features of the model it has
        for b in batches:
            z = np.empty(b.num_rows)
            for i, text in enumerate(b.column("text").to_pylist()):
                found = set()
                for w in set(WORD.findall(text.lower())) if text else ():
                    x = known.get(w)
                    if x is None:
                        if len(known) >= CACHE:
                            known.clear()
                        x = known[w] = tuple(c for c in word_codes(w) if c in weight)
                    if x:
                        found.update(x)
                z[i] = bias + sum(weight[c] for c in sorted(found))
            s = sigmoid(z)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in extra], pa.array(s), pa.array((s >= threshold).astype("i4"))],
                                             names=[*extra, "score", "predicted"])

    rows = docs.select(*dict.fromkeys([*extra, "text"]))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(run, f"{kinds}, score double, predicted int")
