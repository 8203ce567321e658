"""Personal data by a character-level bidirectional LSTM with CRF transitions.

The base rules (e-mail, IP address, payment card, phone) always hold. The
network adds spans they miss: it is trained in numpy, on the driver, from
labelled spans (spans the base rules find in a bounded sample of documents, and
seeded made-up ones in the notations the rules do not know: phones with 00 for
+, cards and phones beside other digits or with dots, e-mails with "(at)"), with
plain numbers, dates and keys as counter-examples.

A text is read in windows of ``WINDOW`` characters that overlap by half. A span of
these kinds needs a digit, an @ or an "(at)", so windows without one cannot hold
any and are passed over; all others are read, wherever they are in the text.
The emissions of overlapping windows are averaged (a window's middle counts
most) and one Viterbi pass over each whole run of windows reconciles them. A long
run is read in pieces of ``PIECE`` characters: the scores go on from piece to piece, and
tags are settled where the best paths to all tags have met, which gives the path of
the whole run; so only a piece, not the text, is held as emissions and back pointers.
A decoded span counts if it passes the kind's own test (Luhn sum, octets up to
255, number of digits, a domain) and touches no base span.

The sample is bounded by ``MAX_DOCS`` documents (documented, chosen by seeded hash of
the id); whole texts of all documents are searched.

Defined cases: null text is the empty text and has no spans; positions count
code points, ends are exclusive; repeated rows are searched as rows; extra
columns are ignored; without any document the made-up spans alone train it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_ids

KINDS = ("email", "ip", "card", "phone")
MAX_DOCS = 400                   # documents learned from, chosen by seeded hash of the id
DOC_PIECES = 2                   # pieces learned from in each of them, chosen by hash of the piece
MADE_UP = 900
WINDOW = 64
PIECE = 32 * WINDOW              # characters of a run read at a time
CELLS = 128 * PIECE              # padded positions of the runs decoded together
HIDDEN = 16
EPOCHS = 8
BATCH = 48
TAGS = 1 + 2 * len(KINDS)        # O, then B- and I- of each kind
CHARS = " \n.-+()@_%,:;/=[]"     # characters with a code of their own
CODES = len(CHARS) + 7           # then lower, upper, digit, wide letter, other white space, other, pad
PAD = CODES - 1

# Base rules. Each starts where its run of characters starts, so no input makes them backtrack.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")
AT = re.compile(r"@|[\[(] ?at ?[\])]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost non-overlapping matches of each rule that pass its test."""
    out = []
    if "@" in text:
        at, free = text.find("@"), 0
        while at >= 0:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append((0, start, m.end()))
                free = m.end()
            at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.findall(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def valid(kind: int, s: str) -> bool:
    """Whether a decoded span may count."""
    digits = "".join(DIGITS.findall(s))
    if kind == 0:
        m = AT.search(s)
        return bool(m) and bool(s[:m.start()].strip()) and DOMAIN.fullmatch(s[m.end():].strip()) is not None and set(s[:m.start()].strip()) <= LOCAL
    if kind == 1:
        parts = s.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits) and digits.strip("0") != "" and set(s) <= set("0123456789 -.")
    return 8 <= len(digits) <= 15 and s.startswith(("+", "00")) and set(s) <= set("0123456789 -.()/+")


def _char_table() -> np.ndarray:
    table = np.full(0x250, CODES - 2, np.int8)
    for i in range(0x250):
        c = chr(i)
        k = CHARS.find(c)
        n = len(CHARS)
        table[i] = (k if k >= 0 else n + 2 if c in "0123456789" else n + 1 if c.isupper() and i < 128 else n if c.isalpha() and i < 128
                    else n + 3 if c.isalpha() else n + 4 if c.isspace() else n + 5)
    return table


CHAR_TABLE = _char_table()


def encode(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return CHAR_TABLE[np.minimum(codes, 0x24F)]


# --- network -------------------------------------------------------------------------------------------------

def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    small = lambda *s: rng.normal(0, 0.3 / np.sqrt(s[0]) ** 0.5, s).astype(np.float32)
    model = {"out": small(2 * HIDDEN, TAGS), "out_b": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32),
             "start": np.zeros(TAGS, np.float32)}
    for d in ("f", "b"):
        model |= {f"x_{d}": small(CODES, 4 * HIDDEN), f"h_{d}": small(HIDDEN, 4 * HIDDEN)}
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN:2 * HIDDEN] = 1.0                    # forget gates start open
        model[f"g_{d}"] = bias
    return model


def _sig(x):
    return 1.0 / (1.0 + np.exp(-x))


def lstm(model, d, x, keep=False):
    """Hidden states (n, t, HIDDEN) of one direction; with ``keep`` also what the backward pass needs."""
    n, t = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out, saved = np.empty((n, t, HIDDEN), np.float32), []
    gates_x, wh = model[f"x_{d}"] + model[f"g_{d}"], model[f"h_{d}"]
    for k in range(t) if d == "f" else range(t - 1, -1, -1):
        z = gates_x[x[:, k]] + h @ wh
        s = _sig(z[:, :3 * HIDDEN])
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        before, was = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, k] = h
        if keep:
            saved.append((k, i, f, o, g, before, tc, was))
    return (out, saved) if keep else out


def lstm_back(model, d, x, saved, dout, grads):
    dh, dc, wh = 0.0, 0.0, model[f"h_{d}"]
    gx, gh, gb = grads[f"x_{d}"], grads[f"h_{d}"], grads[f"g_{d}"]
    for k, i, f, o, g, before, tc, was in reversed(saved):
        dh = dh + dout[:, k]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(gx, x[:, k], dz)
        gh += was.T @ dz
        gb += dz.sum(axis=0)
        dh, dc = dz @ wh.T, dc * f


def emissions(model, x):
    both = np.concatenate([lstm(model, "f", x), lstm(model, "b", x)], axis=2)
    return both @ model["out"] + model["out_b"]


def _lse(a, axis):
    m = a.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))


def crf_grad(model, e, y, live):
    """Mean negative log-likelihood of tag paths, and the gradients of emissions, transitions and start (positions
    that are not ``live`` are padding at the end)."""
    n, t, k = e.shape
    trans = model["trans"]
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = model["start"] + e[:, 0]
    for s in range(1, t):
        nxt = _lse(alpha[:, s - 1, :, None] + trans[None], 1) + e[:, s]
        alpha[:, s] = np.where(live[:, s, None], nxt, alpha[:, s - 1])
    for s in range(t - 2, -1, -1):
        prv = _lse(trans[None] + (e[:, s + 1] + beta[:, s + 1])[:, None, :], 2)
        beta[:, s] = np.where(live[:, s + 1, None], prv, 0.0)
    z = _lse(alpha[:, -1], 1)
    marg = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
    gold = np.eye(k, dtype=np.float32)[y] * live[:, :, None]
    de = marg - gold
    dtrans = np.zeros_like(trans)
    for s in range(1, t):
        p = np.exp(alpha[:, s - 1, :, None] + trans[None] + (e[:, s] + beta[:, s])[:, None, :] - z[:, None, None])
        dtrans += (p * live[:, s, None, None]).sum(axis=0)
        np.add.at(dtrans, (y[:, s - 1][live[:, s]], y[:, s][live[:, s]]), -1.0)
    score = (e * gold).sum((1, 2)) + model["start"][y[:, 0]]
    for s in range(1, t):
        score += np.where(live[:, s], trans[y[:, s - 1], y[:, s]], 0.0)
    return float((z - score).mean()), de / n, dtrans / n, (marg[:, 0] - gold[:, 0]).sum(0) / n


def fit(x, y, live, epochs: int = EPOCHS, lr: float = 0.02, seed: int = 3):
    """Adam on the likelihood of the labelled windows."""
    model, rng = new_model(), np.random.default_rng(seed)
    m, v, t = {k: np.zeros_like(a) for k, a in model.items()}, {k: np.zeros_like(a) for k, a in model.items()}, 0
    steps = max(1, epochs * -(-len(x) // BATCH))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            xb, yb, lb = x[rows], y[rows], live[rows]
            hf, sf = lstm(model, "f", xb, True)
            hb, sb = lstm(model, "b", xb, True)
            both = np.concatenate([hf, hb], axis=2)
            e = both @ model["out"] + model["out_b"]
            _, de, dtrans, dstart = crf_grad(model, e, yb, lb)
            grads = {k: np.zeros_like(a) for k, a in model.items()}
            grads["trans"], grads["start"] = dtrans, dstart
            grads["out"], grads["out_b"] = np.einsum("nth,ntk->hk", both, de, optimize=True), de.sum((0, 1))
            dboth = de @ model["out"].T
            lstm_back(model, "f", xb, sf, dboth[:, :, :HIDDEN], grads)
            lstm_back(model, "b", xb, sb, dboth[:, :, HIDDEN:], grads)
            t += 1
            rate = lr * min(1.0, 2.0 * (1 - t / (steps + 1)))
            for k in model:
                g = np.clip(grads[k], -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model[k] = (model[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return model


def _transitions(model) -> np.ndarray:
    """An I- tag only follows the B- or I- of its kind."""
    k = len(model["trans"])
    bar = np.zeros((k, k), np.float32)
    for j in range(2, k, 2):
        bar[:, j] = -1e4
        bar[j - 1, j] = bar[j, j] = 0.0
    return model["trans"] + bar


def _first_scores(model, e) -> np.ndarray:
    k = e.shape[-1]
    return model["start"] + e + np.where(np.arange(k) % 2 == 0, np.where(np.arange(k) > 0, -1e4, 0.0), 0.0)


def _forward(trans, e, lengths, score):
    """Scores after the padded emissions (n, t, TAGS) and the back pointers of each position, from the scores before."""
    n, t, k = e.shape
    back = np.zeros((n, t, k), np.int8)
    for s in range(t):
        step = score[:, :, None] + trans[None]
        back[:, s] = step.argmax(axis=1)
        score = np.where((lengths > s)[:, None], step.max(axis=1) + e[:, s], score)
    return score, back


def viterbi(model, e, lengths):
    """Best tag path of each row of padded emissions (n, t, TAGS)."""
    n, t, _ = e.shape
    score, back = _forward(_transitions(model), e[:, 1:], lengths - 1, _first_scores(model, e[:, 0]))
    tag, out = score.argmax(axis=1), np.zeros((n, t), np.int8)
    for s in range(t - 1, -1, -1):
        on = s < lengths
        out[:, s] = np.where(on, tag, 0)
        if s:
            tag = np.where(on, back[np.arange(n), s - 1, tag], tag)
    return out


class Path:
    """The best path of one run whose back pointers come in pieces."""

    def __init__(self, length: int):
        self.tags, self.done, self.waiting, self.n, self.retry = np.zeros(length, np.int8), 0, [], 0, 0

    def add(self, back: np.ndarray) -> None:
        """Back pointers of further positions; settles the tags that no later position can change."""
        self.waiting.append(back)
        self.n += len(back)
        if self.n < self.retry:
            return
        rows = np.concatenate(self.waiting)
        at, tags = len(rows), np.arange(TAGS)
        while at and (tags != tags[0]).any():
            at -= 1
            tags = rows[at][tags]
        if at:
            self._settle(rows[:at], int(tags[0]))
            rows = rows[at:].copy()
        self.waiting, self.n, self.retry = [rows], len(rows), 2 * len(rows)

    def end(self, tag: int) -> np.ndarray:
        self._settle(np.concatenate(self.waiting), tag)
        return self.tags

    def _settle(self, rows, tag):
        """Tags of the positions of these back pointers, given the last one."""
        at = self.done + len(rows)
        self.done = at
        for row in rows[::-1]:
            at -= 1
            self.tags[at] = tag
            tag = row[tag]


# --- training data -------------------------------------------------------------------------------------------

def made_up(words: list[str], n: int = MADE_UP, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Seeded texts with labelled spans, among the given words."""
    rng = np.random.default_rng(seed)
    words = words or ["lorem", "ipsum", "dolor", "sit", "amet", "and", "the"]
    pick = lambda s: s[int(rng.integers(len(s)))]
    num = lambda k: "".join(str(int(d)) for d in rng.integers(0, 10, k))

    def card(sep):
        body = pick("456") + num(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return sep.join(body[i:i + 4] for i in range(0, 16, 4))

    def phone(plus, sep):
        return plus + pick(["1", "44", "49", "51", "33"]) + sep + pick([num(3), f"({num(3)})"]) + sep + num(3) + pick([sep or "-", "-"]) + num(4)

    def email(at):
        domain = ".".join([pick(["mail", "post", "box", "web"]) + pick(["", num(1)]), pick(["example", "test", "invalid"]), pick(["com", "org", "net"])])
        return "".join(pick("abcdefghijklmnoprstuvw") for _ in range(int(rng.integers(3, 9)))) + pick(["", ".", "_"]) + pick(["", num(2)]) + "x" + at + domain

    made = [lambda: (0, email("@")), lambda: (0, email(pick(["(at)", "[at]", " (at) "]))),
            lambda: (1, ".".join(str(int(rng.integers(1, 256))) for _ in range(4))), lambda: (2, card(pick(["", "", " ", "-"]))),
            lambda: (2, card(".")), lambda: (3, phone("+", pick([" ", "-", "."]))), lambda: (3, phone("00", pick([" ", "-", "/", ""])))]
    plain = [lambda: num(int(rng.integers(1, 8))), lambda: f"{int(rng.integers(1900, 2031))}-{num(2)}-{num(2)}", lambda: f"{num(2)}:{num(2)}",
             lambda: f"{num(2)}.{num(2)}", lambda: "key=" + "".join(pick("0123456789abcdef") for _ in range(16)), lambda: "AK" + "".join(pick("ABCDEFGHJKLMNP23456789") for _ in range(16)),
             lambda: f"{num(1)},{num(3)},{num(3)}", lambda: "v" + num(1) + "." + num(1) + "." + num(2)]
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(int(rng.integers(1, 4))):
            text += " ".join(pick(words) for _ in range(int(rng.integers(1, 5)))) + pick([" ", " ", ": ", ", ", "\n"])
            if rng.random() < 0.15:
                text += num(int(rng.integers(1, 4))) + " "
            if rng.random() < 0.65:
                kind, s = pick(made)()
                spans.append((kind, len(text), len(text) + len(s)))
                text += s + pick([" ", " ", ". ", ", "])
            else:
                text += pick(plain)() + " "
        out.append((text, spans))
    return out


def labelled_windows(samples):
    """Code, tag and live matrices of WINDOW-wide pieces around the anchors of labelled texts."""
    xs, ys, ls = [], [], []
    for text, spans in samples:
        codes, tags = encode(text), np.zeros(len(text), np.int8)
        for kind, a, b in spans:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
        for k in _window_numbers(text):
            a = k * (WINDOW // 2)
            piece = codes[a:a + WINDOW]
            if not len(piece):
                continue
            x, y = np.full(WINDOW, PAD, np.int8), np.zeros(WINDOW, np.int8)
            x[:len(piece)], y[:len(piece)] = piece, tags[a:a + WINDOW]
            if y[0] and y[0] % 2 == 0:                   # a piece that begins inside a span
                y[0] -= 1
            xs.append(x), ys.append(y), ls.append(np.arange(WINDOW) < len(piece))
    return np.array(xs), np.array(ys, dtype=np.int64), np.array(ls)


def _window_numbers(text: str) -> list[int]:
    """Numbers of the half-overlapping windows that hold an anchor."""
    half, found = WINDOW // 2, set()
    for m in ANCHOR.finditer(text):
        k = m.start() // half
        found.update((k, max(0, k - 1)))
        if m.end() - m.start() > 1:
            found.add((m.end() - 1) // half)
    return sorted(found)


def train(docs: DataFrame, max_docs: int = MAX_DOCS, made: int = MADE_UP, epochs: int = EPOCHS):
    """The network, from a bounded sample (at most ``max_docs`` documents that hold an anchor, ``DOC_PIECES`` pieces of
    each, whatever their length) and from made-up spans."""
    some = docs.where(F.col("text").rlike("[0-9@]"))
    ids = bounded_ids(some, "doc_id", max_docs, "pii")
    # At most max_docs ids: a broadcast with a fixed bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")

    def pieces(batches):
        """Only the neighbourhood of some anchors leaves the executors, with its base spans."""
        for b in batches:
            out = []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                spans, at, found = base_spans(text), -1, {}
                for m in ANCHOR.finditer(text):
                    if m.start() < at:
                        continue
                    a, z = max(0, m.start() - 60), min(len(text), m.start() + 100)
                    at = z
                    inside = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= z]
                    cut = [s for _, s, e in spans if s < a < e or s < z < e]
                    if not cut:
                        found[text[a:z]] = ",".join(f"{k}:{s}:{e}" for k, s, e in inside)
                chosen = sorted(found, key=lambda x: hashlib.md5(x.encode("utf-8", "surrogatepass")).digest())[:DOC_PIECES]
                out += [(i, piece, found[piece]) for piece in chosen]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([o[0] for o in out], pa.int64()), "piece": pa.array([o[1] for o in out], pa.string()),
                                              "spans": pa.array([o[2] for o in out], pa.string())})

    got = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, "doc_id long, piece string, spans string").collect()
    got = sorted({(r["doc_id"], r["piece"], r["spans"]) for r in got})       # an id may stand in several rows
    real = [(p, [tuple(map(int, s.split(":"))) for s in sp.split(",")] if sp else []) for _, p, sp in got]
    words = sorted({w for p, _ in real for w in p.split() if w.isalpha()})[:2000]
    x, y, live = labelled_windows(real + made_up(words, made))
    return fit(x, y, live, epochs)


# --- search --------------------------------------------------------------------------------------------------

def _runs(text: str) -> list[tuple[int, int, int]]:
    """(first position, last position, windows) of the runs of half-overlapping windows that hold an anchor."""
    half, out, numbers = WINDOW // 2, [], _window_numbers(text)
    start = prev = numbers[0] if numbers else 0
    for k in numbers[1:] + [None] * bool(numbers):
        if k is None or k != prev + 1:
            a, b = start * half, min(len(text), prev * half + WINDOW)
            out.append((a, b, max(1, -(-(b - a - half) // half))))
            start = k
        prev = k
    return out


def _read(model, texts, jobs, p: int, chunk: int = 512):
    """Padded emissions of the positions p to p + PIECE of each run, overlapping windows averaged, and their numbers."""
    half = WINDOW // 2
    lengths = np.array([min(PIECE, b - a - p) for _, a, b, _ in jobs])
    windows = [(r, j * half - p) for r, (_, _, _, n) in enumerate(jobs) for j in range(max(0, p // half - 1), min(n, -(-(p + lengths[r]) // half)))]
    x = np.full((len(windows), WINDOW), PAD, np.int8)
    last = None
    for w, (r, at) in enumerate(windows):
        if r != last:
            i, a, b, _ = jobs[r]
            codes, last, origin = encode(texts[i][max(a, a + p - half):a + p + PIECE + half]), r, max(0, p - half) - p
        piece = codes[at - origin:at - origin + WINDOW]
        x[w, :len(piece)] = piece
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
    total, mass = np.zeros((len(jobs), lengths.max(), TAGS), np.float32), np.zeros((len(jobs), lengths.max(), 1), np.float32)
    for c in range(0, len(windows), chunk):
        e = emissions(model, x[c:c + chunk]) * weight
        for row, (r, at) in zip(e, windows[c:c + chunk]):
            lo, hi = max(0, at), min(at + WINDOW, lengths[r])
            total[r, lo:hi] += row[lo - at:hi - at]
            mass[r, lo:hi] += weight[lo - at:hi - at]
    return total / np.maximum(mass, 1e-6), lengths


def _decode_runs(model, texts, jobs):
    """The tags of each run of a group."""
    if max(b - a for _, a, b, _ in jobs) <= PIECE:
        e, lengths = _read(model, texts, jobs, 0)
        yield from ((j, tags[:n]) for j, tags, n in zip(jobs, viterbi(model, e, lengths), lengths))
        return
    trans, paths, score = _transitions(model), [Path(b - a) for _, a, b, _ in jobs], None
    live, p = list(range(len(jobs))), 0
    while live:
        e, lengths = _read(model, texts, [jobs[r] for r in live], p)
        if p:
            score, back = _forward(trans, e, lengths, score - score.max(axis=1, keepdims=True))
        else:
            score, back = _forward(trans, e[:, 1:], lengths - 1, _first_scores(model, e[:, 0]))
            back = np.concatenate([np.zeros_like(back, shape=(len(back), 1, TAGS)), back], axis=1)
        for r, rows, n in zip(live, back, lengths):
            paths[r].add(rows[:n].copy())
        p += PIECE
        stay = [k for k, r in enumerate(live) if jobs[r][2] - jobs[r][1] > p]
        for k in set(range(len(live))) - set(stay):
            yield jobs[live[k]], paths[live[k]].end(int(score[k].argmax()))
        live, score = [live[k] for k in stay], score[stay]


def decode(model, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans the network reads in each text, windows reconciled over whole runs."""
    jobs = sorted(((i, *run) for i, text in enumerate(texts) for run in _runs(text)), key=lambda j: j[2] - j[1])
    groups = []
    for job in jobs:                                     # by length, so the newest run is the widest
        width = min(PIECE, job[2] - job[1])
        if not groups or (len(groups[-1]) + 1) * width > CELLS:
            groups.append([])
        groups[-1].append(job)
    out = [[] for _ in texts]
    for group in groups:
        for (i, a, _, _), tags in _decode_runs(model, texts, group):
            for s in np.flatnonzero(tags % 2 == 1).tolist():
                z = s + 1
                while z < len(tags) and tags[z] == tags[s] + 1:
                    z += 1
                out[i].append(((int(tags[s]) - 1) // 2, a + s, a + z))
    return out


def added_spans(text: str, base, read) -> list[tuple[int, int, int]]:
    """The read spans, trimmed, that pass their test and touch no base span (nor an added one)."""
    order = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in order], list(accumulate((e for _, e in order), max))
    free, out = 0, []                                    # read spans do not overlap, so the last end is enough
    for kind, s, e in sorted(read, key=lambda r: (r[1], r[0])):
        while s < e and text[s] in " \n,;:=(" and kind != 3:
            s += 1
        while e > s and text[e - 1] in " \n,;:.)(":
            e -= 1
        if e > s and valid(kind, text[s:e]) and free <= s and not ((k := bisect_left(starts, e)) and reach[k - 1] > s):
            beside = (s > 0 and text[s - 1].isdigit()) or (e < len(text) and text[e].isdigit())
            if not beside:                               # half of a longer number is no finding
                out.append((kind, s, e))
                free = e
    return out


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_in(model, texts: list[str]):
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    read = decode(model, texts)
    return [(b, sorted(b + added_spans(t, b, r))) for t, b, r in zip(texts, base, read)]


def _portions(texts, chars: int = 4_000_000):
    """Index ranges of about so many characters: the working set stays bounded."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def find(docs: DataFrame, model) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (all spans of the kind), base_sha256, spans."""
    def run(batches):
        for b in batches:
            ids, texts = b.column("doc_id"), [t or "" for t in b.column("text").to_pylist()]
            counts, sha, spans = [], [], []
            for lo, hi in _portions(texts):
                for base, every in find_in(model, texts[lo:hi]):
                    counts.append([sum(s[0] == k for s in every) for k in range(4)])
                    sha.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                    spans.append(spans_text(every))
            n = np.array(counts, dtype="i8").reshape(len(texts), 4)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(n[:, k]) for k in range(4)], pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                                             names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are masked together under the first kind."""
    parts, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            parts += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def masked_documents(docs: DataFrame, model) -> DataFrame:
    """The documents with personal data masked in their texts (n_chars follows the text); all columns stay."""
    names = docs.columns
    text_at = names.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(text_at).to_pylist()
            new = []
            for lo, hi in _portions([t or "" for t in texts]):
                part = [t or "" for t in texts[lo:hi]]
                for t, (_, every), was in zip(part, find_in(model, part), texts[lo:hi]):
                    new.append(was if was is None else mask(t, every) if every else t)
            yield b.set_column(text_at, names[text_at], pa.array(new, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
