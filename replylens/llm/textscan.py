"""Tokens of many texts at once: numpy passes over the UTF-8 bytes, no loop over words.

A byte class table says which bytes belong to a word. Word hashes come from prefix
polynomials modulo 2^64 over random byte values (the polynomial of a word is the
difference of two prefixes, shifted back by the inverse power), so a word has the
same 64-bit hash wherever it stands. Sequences of words are hashed the same way
from the word hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1 << 18                      # bytes hashed at a time
SLICE = 1 << 21                      # bytes of texts handled together (one longer text is a slice of its own)


def bitmix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
        return x ^ (x >> U(32))


def _odd_base(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, 1 << 63)) | 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, seed: int):
        self.base = _odd_base(seed)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, "u8")

    def upto(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            grow = np.ones(size, "u8")
            with np.errstate(over="ignore"):
                grow[1:] = U(self.base)
                self.up = np.cumprod(grow, dtype="u8")
                grow[1:] = U(self.inverse)
                self.down = np.cumprod(grow, dtype="u8")
        return self.up, self.down


def byte_set(chars: bytes) -> np.ndarray:
    """Table of 256 flags: True for the given bytes."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


class Scanner:
    """Finds and hashes words. ``word``: flags of the bytes that words are made of. A-Z count as a-z in hashes."""

    def __init__(self, word: np.ndarray, seed: int = 1):
        values = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype="u8")
        values[65:91] = values[97:123]
        self.word, self.values = word, values
        self.bytes, self.words = Powers(seed + 101), Powers(seed + 202)

    def find(self, data: np.ndarray):
        """Start, end (exclusive) and hash of every word."""
        inside = self.word[data].view("i1")
        edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out = np.empty(len(start), "u8")
        at = 0
        while at < len(start):                           # pieces of whole words, so long texts need no long arrays
            to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, side="right")))
            lo, hi = int(start[at]), int(end[to - 1])
            up, down = self.bytes.upto(hi - lo)
            total = np.zeros(hi - lo + 1, "u8")
            with np.errstate(over="ignore"):
                np.cumsum(self.values[data[lo:hi]] * up[:hi - lo], out=total[1:])
                s, e = start[at:to] - lo, end[at:to] - lo
                out[at:to] = (total[e] - total[s]) * down[s]
            at = to
        return start, end, bitmix(out + (end - start).astype("u8"))

    def sequences(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hash of every run of ``n`` word hashes (len(words) - n + 1 of them)."""
        count = len(words) - n + 1
        if count <= 0:
            return np.empty(0, "u8")
        up, down = self.words.upto(len(words))
        total = np.zeros(len(words) + 1, "u8")
        with np.errstate(over="ignore"):
            np.cumsum(words * up[:len(words)], out=total[1:])
            return bitmix((total[n:] - total[:count]) * down[:count] + U(n))


@dataclass
class Slice:
    """Some texts of a batch in one buffer, parted by line feeds; ``rows``: their places in the batch."""
    rows: range
    data: np.ndarray
    first: np.ndarray                # where each text starts

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Which text of the slice a place belongs to."""
        return np.searchsorted(self.first, at, side="right") - 1


def slices(texts: pa.Array, limit: int = SLICE, rows: int = 256):
    """The texts of a column (null: empty) as slices of about ``limit`` bytes and at most ``rows`` texts."""
    for lo in range(0, len(texts), rows):
        raw = [t or b"" for t in texts.slice(lo, rows).cast(pa.binary()).to_pylist()]
        at = 0
        while at < len(raw):
            to, size = at, 0
            while to < len(raw) and (to == at or size + len(raw[to]) < limit):
                size += len(raw[to]) + 1
                to += 1
            lengths = np.array([len(t) + 1 for t in raw[at:to]], "i8")
            yield Slice(range(lo + at, lo + to), np.frombuffer(b"\n".join(raw[at:to]) + b"\n", "u1"), np.cumsum(lengths) - lengths)
            at = to
