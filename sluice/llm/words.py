"""Words of many texts as numpy arrays: word bounds, 64-bit word hashes and hashes of word runs.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so words of UTF-8 need no decoding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from sluice.llm.common import mix

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Characters that are hashed at a time (a longer word is hashed whole).
SLAB = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASES = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _table(seed: int, lower: bool) -> np.ndarray:
    t = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 10) + _ODD)
    return t[_LOWER] if lower else t


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    buffer: np.ndarray  #: the texts' bytes, a space after each
    starts: np.ndarray  #: of the words, in buffer
    ends: np.ndarray
    first: np.ndarray  #: word number at which each text begins, and the number of all words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, A-Z lower-cased first if asked for."""
        out = np.empty(len(self.starts), np.uint64)
        if not len(out):
            return out
        lens = self.ends - self.starts
        table, total = _table(seed, lower), np.cumsum(lens)
        power = _powers(_BASES[seed % 2], int(lens.max()))
        cut = np.unique(np.searchsorted(total, np.arange(0, int(total[-1]) + 1, SLAB), "left"))
        for i, j in zip(cut, [*cut[1:], len(out)], strict=True):  # what is held by character is bounded
            if i < j:
                n = lens[i:j]
                at = np.cumsum(n) - n
                seg = self.buffer[self.starts[i] : self.ends[j - 1]]
                c = seg[~SPACE[seg]]
                pos = np.arange(len(c), dtype=np.int64)
                pos -= np.repeat(at, n)
                v = table[c]
                v *= power[pos]
                out[i:j] = mix(np.add.reduceat(v, at) + n.astype(np.uint64) * _ODD)
        return out


def split(texts: list[bytes]) -> Words:
    buffer = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    space = SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    return Words(buffer, starts, ends, first)


def runs(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of h[i:i+k] for each i that has k words; text bounds are the caller's concern."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _BASES[(seed + 1) % 2]
    out, have, power = None, 0, h
    size = 1
    left = k
    while left:  # k in binary: hashes of 1, 2, 4, ... words are put together
        if left & 1:
            scale = np.uint64(pow(int(base), have, 1 << 64))
            part = power[have : have + n] * scale
            out = part if out is None else out + part
            have += size
        left >>= 1
        if left:
            power = power[:-size] + power[size:] * np.uint64(pow(int(base), size, 1 << 64))
            size *= 2
    return mix(out + np.uint64(k * int(_ODD) % (1 << 64)))


def sliding(x: np.ndarray, size: int, least: np.ufunc) -> np.ndarray:
    """least.reduce of x[i:i+size] for each i that has size values."""
    if len(x) < size:
        return x[:0]
    width, y = 1, x
    while 2 * width <= size:
        y = least(y[:-width], y[width:])
        width *= 2
    return least(y[: len(x) - size + 1], y[size - width :][: len(x) - size + 1])


def shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word runs of each text, one of the whole text if it has fewer words; and how many each has."""
    counts = w.counts
    long = counts >= k
    sizes = np.where(long, counts - k + 1, counts > 0)
    all_runs = runs(h, k)
    keep = np.zeros(len(h), bool)
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint64)
    n_long = np.where(long, sizes, 0)
    if n_long.any():
        index = np.repeat(w.first[:-1], n_long) + np.arange(int(n_long.sum())) - np.repeat(np.cumsum(n_long) - n_long, n_long)
        keep = np.repeat(long, sizes)
        out[keep] = all_runs[index]
    for i in np.flatnonzero(~long & (counts > 0)):
        out[at[i]] = runs(h[w.first[i] : w.first[i + 1]], int(counts[i]))[0]
    return out, sizes
