"""Text quality by a generalised additive model with pairwise interactions.

Every document becomes a short vector of measures (shares of character classes,
word statistics, repetition). Each measure is cut into quantile bins, and the
model is a sum of lookup tables: one per measure and one per chosen pair of
measures. The tables are learned by cyclic boosting: round after round every
measure in turn gets a shallow tree (at most three cuts) fitted to the current
gradients of the log loss, added to its table with a small step. Pairs are then
ranked by how much one 2 x 2 split of their bins explains of what is left, and
the best ``PAIRS`` are boosted in the same way. Scoring is a bin search and a sum of
table entries, vectorised over a batch.

The fit takes at most ``MAX_ROWS`` labelled rows (documented sample bound, chosen by
seeded hash of the id); whole texts of all rows are scored.

Defined cases: null and empty texts have all measures 0; without labels, or with
one class only, the score is the smoothed class share; repeated rows are scored
as rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_ids

MAX_ROWS = 20_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
STEP = 0.15
CUTS = 3
MIN_LEAF = 8
FEATURES = ["log_chars", "letters", "upper", "digits", "spaces", "stops", "commas", "marks", "other_ascii", "wide",
            "word_length", "short_words", "long_words", "distinct_words", "top_word", "words_a_stop", "repeated_lines",
            "repeated_pairs", "marked_words", "upper_words", "log_lines", "packed"]


def _classes() -> np.ndarray:
    """Class of a code point below 0x250: 0 other ASCII, 1 lower letter, 2 upper, 3 digit, 4 white space, 5 sentence end,
    6 comma-like, 7 bracket, quote or dash, 8 above ASCII without case."""
    table = np.zeros(0x250, np.int8)
    for i in range(0x250):
        c = chr(i)
        table[i] = (2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 5 if c in ".!?"
                    else 6 if c in ",;:" else 7 if c in "'\"()-[]" else 0 if i < 128 else 8)
    return table


CLASSES = _classes()


def measures(text: str | None) -> list[float]:
    """The FEATURES of one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(CLASSES[np.minimum(codes, 0x24F)], minlength=9)
    n = len(codes)
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), "i8", len(words))
    marked = sum(k for w, k in counts.items() if not (w[-1].isalnum() or w[-1] in ".,;:!?)\"'") or not (w[0].isalnum() or w[0] in "(\"'+"))
    shouted = sum(k for w, k in counts.items() if w.isupper() and len(w) > 1)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    raw = text.encode("utf-8", "surrogatepass")
    # Size after compression, over slices so that a long text is no special case.
    packed = sum(len(zlib.compress(raw[i:i + 65536], 1)) for i in range(0, len(raw), 65536)) / len(raw)
    return [float(np.log1p(n)), (kinds[1] + kinds[2]) / n, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / m, kinds[6] / m,
            kinds[7] / m, kinds[0] / m, kinds[8] / n, float(lengths.mean()) if len(words) else 0.0, float((lengths <= 3).sum()) / m,
            float((lengths >= 12).sum()) / m, len(counts) / m, max(counts.values(), default=0) / m, m / (1 + kinds[5]),
            1 - len(set(lines)) / max(1, len(lines)), 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0, marked / m,
            shouted / m, float(np.log1p(len(lines))), packed]


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Ascending distinct inner edges per column, at quantiles of the sample."""
    q = np.arange(1, bins) / bins
    return [np.unique(np.quantile(col, q, method="inverted_cdf")) for col in x.T]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, col, side="left") for col, e in zip(x.T, edges)], axis=1)


def shallow_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, cuts: int = CUTS, min_leaf: int = MIN_LEAF, l2: float = 1.0):
    """Newton steps of a tree of at most ``cuts`` cuts over ordered bins; the best next cut is taken each time."""
    g, h, c = (np.concatenate([[0], np.cumsum(v)]) for v in (grad, hess, count))
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + l2)
    parts = [(0, len(grad))]
    for _ in range(cuts):
        best = (1e-9, None, None)
        for i, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gain = value(a, k) + value(k, b) - value(a, b)
            gain = np.where((c[k] - c[a] >= min_leaf) & (c[b] - c[k] >= min_leaf), gain, -1.0)
            j = int(np.argmax(gain))
            if gain[j] > best[0]:
                best = (gain[j], i, int(k[j]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = -(g[b] - g[a]) / (h[b] - h[a] + l2)
    return out


def _sums(flat, size, *values):
    return [np.bincount(flat, weights=v, minlength=size) for v in values]


def best_quad(grad, hess, l2: float = 1.0):
    """Best single 2 x 2 split of a table of sums: (gain, row cut, column cut)."""
    G, H = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    if min(grad.shape) < 2:
        return 0.0, 0, 0
    gain = np.zeros((grad.shape[0] - 1, grad.shape[1] - 1))
    for S in ((G, H),):
        a, ah = S[0][:-1, :-1], S[1][:-1, :-1]
        r, rh = S[0][:-1, -1:], S[1][:-1, -1:]
        c, ch = S[0][-1:, :-1], S[1][-1:, :-1]
        t, th = S[0][-1, -1], S[1][-1, -1]
        for x, y in ((a, ah), (r - a, rh - ah), (c - a, ch - ah), (t - r - c + a, th - rh - ch + ah)):
            gain += x ** 2 / (y + l2)
        gain -= t ** 2 / (th + l2)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[i, j]), int(i) + 1, int(j) + 1


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS):
    """{base, edges, tables, pairs: [(i, j, table)]}."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    model = {"base": float(np.log(share / (1 - share))), "edges": [np.empty(0)] * len(FEATURES), "tables": [np.zeros(1)] * len(FEATURES), "pairs": []}
    if len(y) < 2 * MIN_LEAF or y.min() == y.max():
        return model
    edges = bin_edges(x)
    b = to_bins(x, edges)
    size = [len(e) + 1 for e in edges]
    ones = np.ones(len(y))
    counts = [_sums(b[:, f], size[f], ones)[0] for f in range(x.shape[1])]
    tables = [np.zeros(s) for s in size]
    z = np.full(len(y), model["base"])
    for _ in range(rounds):
        for f in range(x.shape[1]):
            p = 1 / (1 + np.exp(-z))
            g, h = _sums(b[:, f], size[f], p - y, p * (1 - p))
            step = STEP * shallow_tree(g, h, counts[f])
            tables[f] += step
            z += step[b[:, f]]
    p = 1 / (1 + np.exp(-z))
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            g, h = (s.reshape(size[i], size[j]) for s in _sums(b[:, i] * size[j] + b[:, j], size[i] * size[j], p - y, p * (1 - p)))
            ranked.append((-best_quad(g, h)[0], i, j))
    chosen = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in sorted(ranked)[:pairs]]
    for _ in range(pair_rounds):
        for i, j, table in chosen:
            p = 1 / (1 + np.exp(-z))
            g, h = (s.reshape(size[i], size[j]) for s in _sums(b[:, i] * size[j] + b[:, j], size[i] * size[j], p - y, p * (1 - p)))
            gain, r, c = best_quad(g, h)
            if gain <= 1e-9:
                continue
            step = np.zeros_like(table)
            for rows in (slice(0, r), slice(r, None)):
                for cols in (slice(0, c), slice(c, None)):
                    step[rows, cols] = -STEP * g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
            table += step
            z += step[b[:, i], b[:, j]]
    return model | {"edges": edges, "tables": tables, "pairs": chosen}


def apply(model, x: np.ndarray) -> np.ndarray:
    """Scores 0..1 of a batch of measure vectors."""
    b = to_bins(x, model["edges"])
    z = np.full(len(x), model["base"])
    for f, t in enumerate(model["tables"]):
        z += t[b[:, f]]
    for i, j, t in model["pairs"]:
        z += t[b[:, i], b[:, j]]
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, learn, max_rows: int = MAX_ROWS):
    """``learn``: function of an id column, true where labels may be learned from. Of several labels of an id the lowest counts."""
    known = labels.where(learn(F.col("doc_id")) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = bounded_ids(known, "doc_id", max_rows, "quality")
    # At most max_rows ids and labels: a broadcast with a fixed bound.
    chosen = known.join(F.broadcast(ids), "doc_id", "left_semi")
    chosen = chosen.limit(max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "inner")

    def vectors(batches):
        for b in batches:
            x = [np.asarray(measures(t), "<f8").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality").cast(pa.int64()), pa.array(x, pa.binary())],
                                             names=["doc_id", "quality", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", "quality", "text").mapInArrow(vectors, f"doc_id {kind}, quality long, x binary").collect()
    got = sorted((r["doc_id"], r["quality"], bytes(r["x"])) for r in got)
    x = np.array([np.frombuffer(r[2], "<f8") for r in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([float(r[1] > 0) for r in got]))


def score(docs: DataFrame, model, extra: list[str], threshold: float = 0.3) -> DataFrame:
    """``extra`` + score and predicted (score >= threshold) for every whole text."""
    def run(batches):
        for b in batches:
            x = np.array([measures(t) for t in b.column("text").to_pylist()]).reshape(b.num_rows, len(FEATURES))
            s = apply(model, x)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in extra], pa.array(s), pa.array((s >= threshold).astype("i4"))],
                                             names=[*extra, "score", "predicted"])

    rows = docs.select(*dict.fromkeys([*extra, "text"]))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(run, f"{kinds}, score double, predicted int")
