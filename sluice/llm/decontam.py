"""Benchmark decontamination: item-sized windows by SimHash, found through a multi-index, verified on word shingles.

A window of as many words as a benchmark item is a leak of it if the weighted Jaccard similarity of their k-word
shingles (each weighted by how often it stands there) is ``percent`` or more. A text of fewer words than the item is one
window. Words are runs of non-space bytes, A-Z lower-cased.

Every text is read whole, once for every ``scan_bytes`` of items, and nothing is shuffled:

1. A count filter that is exact: similarity s of two bags of m shingles needs 2 s m / (1 + s) shingles in common, so
   only windows with that many shingles of some item go on. For a whole text of m' shingles it is s (m + m') / (1 + s);
   what passes is verified without a fingerprint.
2. A window's fingerprint is a 252-bit SimHash of its shingles, the i-th copy of one counting as a shingle of its own, so
   that the cosine behind it is the share of shingles in common whatever repeats. A window at 75 % shares 6/7 of them and
   differs in 43 bits (deviation 6). Fingerprints are looked up in a multi-index of 14 blocks of 18 bits: within Hamming
   distance 69 some block differs in 4 bits at most, so every fingerprint of the radius is found, by the items' blocks
   with up to 2 bits flipped and the window's with up to 2 more. Of random pairs 19 % share such a block.
3. What is found within the radius is verified exactly; each (document, item) keeps its best and earliest window.

What a task holds is bounded whatever the benchmark's size: items go in blocks of at most ``block_bytes`` of text, a
scan takes blocks of ``scan_bytes`` in sum, and the indexes of ``KEPT`` item lengths at most are remembered.
Items of fewer than k words count as one shingle; empty or null ones and empty documents match nothing. Repeated rows
each give their own result rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import words
from sluice.llm.common import by_chunk, mix, prepare

#: A block's value may differ in 2 * FLIPS bits; a radius under BLOCKS * (2 * FLIPS + 1) is guaranteed.
BITS, BLOCKS, FLIPS, RADIUS, KEPT = 252, 14, 2, 69, 64
_REGION = 8192

_WIDE = BITS // BLOCKS
_MASKS = np.array([sum(1 << i for i in c) for n in range(FLIPS + 1) for c in itertools.combinations(range(_WIDE), n)], np.int32)
_SEEDS = tuple(np.uint64(x) for x in (0xA5A5A5A5A5A5A5A5, 0x0F1E2D3C4B5A6978, 0x3C6EF372FE94F82B, 0x510E527FADE682D1))


def _votes(h: np.ndarray) -> np.ndarray:
    """+1 or -1 of each shingle for each bit."""
    parts = np.stack([mix(h ^ s) for s in _SEEDS], axis=1)
    bits = np.unpackbits(parts.view(np.uint8).reshape(len(h), 32), axis=1)[:, :BITS]
    return bits.astype(np.int8) * 2 - 1


def _numbered(bag: np.ndarray) -> np.ndarray:
    """A bag as a set: the i-th copy of a shingle is one of its own."""
    order = np.argsort(bag, kind="stable")
    own = bag[order]
    new = np.concatenate(([True], own[1:] != own[:-1]))
    first = np.flatnonzero(new)
    copy = np.arange(len(own)) - np.repeat(first, np.diff(np.concatenate((first, [len(own)]))))
    return own + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _print(bag: np.ndarray) -> np.ndarray:
    """The fingerprint of one bag of shingles, as BITS zeros and ones."""
    return (_votes(_numbered(bag)).sum(axis=0, dtype=np.int32) > 0).astype(np.uint8)


def fingerprints(sh: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """Of each window sh[s:s+m], as BITS zeros and ones; starts ascend."""
    edge = np.zeros(len(sh) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + m, -1)
    covered = np.cumsum(edge[:-1]) > 0  # votes are cast by the shingles of windows only
    sh, starts = sh[covered], (np.cumsum(covered) - 1)[starts]
    order = np.argsort(sh, kind="stable")
    before = np.full(len(sh), -1)
    same = sh[order[1:]] == sh[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    latest = words.sliding(before, m, np.maximum)[starts]
    out = np.empty((len(starts), BITS), np.uint8)
    cut = np.flatnonzero(np.concatenate(([True], np.diff(starts // _REGION) > 0)))
    for a, b in zip(cut, [*cut[1:], len(starts)], strict=True):
        own = starts[a:b] - starts[a]
        votes = _votes(sh[starts[a] : starts[b - 1] + m])
        total = np.zeros((len(votes) + 1, BITS), np.int32)
        np.cumsum(votes, axis=0, out=total[1:])
        out[a:b] = total[own + m] > total[own]
    for i in np.flatnonzero(latest >= starts):  # a shingle stands twice in the window
        out[i] = _print(sh[starts[i] : starts[i] + m])
    return out


def _values(prints: np.ndarray) -> np.ndarray:
    """(fingerprint, block): each block's bits as a number, with the block's own number above them."""
    value = prints.reshape(-1, BLOCKS, _WIDE) @ (1 << np.arange(_WIDE, dtype=np.int64))
    return value + (np.arange(BLOCKS, dtype=np.int64) << _WIDE)


class Index:
    """Multi-index of the fingerprints of items of one length."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        keys = (_values(prints)[:, :, None] ^ _MASKS).reshape(-1).astype(np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.item = keys[order], (order // (BLOCKS * len(_MASKS))).astype(np.int32)
        known = np.zeros(BLOCKS << _WIDE, bool)
        known[keys] = True
        self.known = np.packbits(known, bitorder="little")

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) pairs of which some block differs in 2 * FLIPS bits at most."""
        out = [np.zeros(0, np.int64)]
        for a in range(0, len(prints), 256):
            wanted = (_values(prints[a : a + 256])[:, :, None] ^ _MASKS).reshape(-1).astype(np.int32)
            hit = np.flatnonzero(self.known[wanted >> 3] >> (wanted & 7).astype(np.uint8) & 1)
            begin, end = np.searchsorted(self.keys, wanted[hit]), np.searchsorted(self.keys, wanted[hit], "right")
            n = end - begin
            at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            out.append(np.unique((np.repeat(hit // (BLOCKS * len(_MASKS)), n) + a) * len(self.prints) + self.item[at]))
        return np.divmod(np.concatenate(out), len(self.prints))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs within the radius."""
        x, y = self.candidates(prints)
        keep = (prints[x] != self.prints[y]).sum(axis=1) <= RADIUS
        return x[keep], y[keep]


class Items:
    """Benchmark items of one block: shingle bags, and the multi-indexes of their fingerprints by length."""

    def __init__(self, ids: list[int], texts: list[bytes], k: int, percent: int):
        self.k, self.percent = k, percent
        w = words.split(texts)
        h = w.hashes(lower=True)
        self.ids, self.n, self.bags = [], [], []
        for i, item in enumerate(ids):
            own = h[w.first[i] : w.first[i + 1]]
            if len(own):
                self.ids.append(item)
                self.n.append(len(own))
                self.bags.append(np.unique(words.runs(own, min(k, len(own))), return_counts=True))
        self.ids = np.array(self.ids, np.int64)
        self.n = np.array(self.n, np.int64)
        self.indexes: dict[int, Index] = {}
        self.known = {}
        for size in sorted(set(np.minimum(self.n, k).tolist())):
            self.known[size] = np.unique(np.concatenate([b[0] for b, n in zip(self.bags, self.n, strict=True) if min(n, k) == size]))

    def near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of n-word items within the radius of the windows' fingerprints."""
        own = np.flatnonzero(self.n == n)
        if n not in self.indexes:
            if len(self.indexes) >= KEPT:
                self.indexes.clear()
            self.indexes[n] = Index(np.array([_print(np.repeat(*self.bags[i])) for i in own]))
        x, y = self.indexes[n].near(prints)
        return x, own[y]

    def similarity(self, bag: np.ndarray, item: int) -> tuple[int, int]:
        """Weighted intersection and union of a window's shingles with an item's."""
        mine, times = np.unique(bag, return_counts=True)
        theirs, counts = self.bags[item]
        at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
        same = int(np.minimum(times, counts[at])[theirs[at] == mine].sum())
        return same, len(bag) + int(counts.sum()) - same


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array known, mostly decided by 20 of their bits."""
    table = np.zeros(1 << 20, bool)
    low = np.uint64((1 << 20) - 1)
    table[known & low] = True
    out = table[values & low]
    at = np.flatnonzero(out)
    place = np.minimum(np.searchsorted(known, values[at]), len(known) - 1)
    out[at] = known[place] == values[at]
    return out


def leaks_in(texts: list[bytes], blocks: list[Items]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text number, item_id, start, words, intersection, union) of the best window of each text and item."""
    w = words.split(texts)
    h = w.hashes(lower=True)
    for items in blocks:
        for doc, item, *found in _leaks(w, h, items):
            yield doc, int(items.ids[item]), *found


def _leaks(w: words.Words, h: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, int, int]]:
    end = np.repeat(w.first[1:], w.counts)
    for size, known in items.known.items():
        if len(h) < size:
            continue
        sh = words.runs(h, size)
        hit = _member(sh, known)
        if not hit.any():
            continue
        total = np.concatenate(([0], np.cumsum(hit)))
        best: dict[tuple[int, int], tuple] = {}
        for n in np.unique(items.n[np.minimum(items.n, items.k) == size]).tolist():
            m = n - size + 1
            least = -(-2 * items.percent * m // (100 + items.percent))
            short = np.flatnonzero((w.counts < n) & (w.counts >= size))
            mine = w.counts[short] - size + 1
            common = total[w.first[short] + mine] - total[w.first[short]]
            for doc in short[(100 + items.percent) * common >= items.percent * (m + mine)].tolist():
                at, length = int(w.first[doc]), int(w.counts[doc])
                for item in np.flatnonzero(items.n == n).tolist():
                    same, union = items.similarity(sh[at : at + length - size + 1], item)
                    if 100 * same >= items.percent * union:
                        best[doc, item] = (-same / union, 0, length, same, union)
            if len(h) < n:
                continue
            s = np.flatnonzero(total[m:] - total[: len(total) - m] >= least)
            s = s[s + n <= end[s]]
            if not len(s):
                continue
            for a in range(0, len(s), _REGION):
                starts = s[a : a + _REGION]
                base = int(starts[0])
                prints = fingerprints(sh[base : int(starts[-1]) + m], starts - base, m)
                for x, item in zip(*items.near(prints, n), strict=True):
                    at = int(starts[x])
                    same, union = items.similarity(sh[at : at + m], item)
                    if 100 * same >= items.percent * union:
                        doc = int(np.searchsorted(w.first, at, "right") - 1)
                        key, new = (doc, int(item)), (-same / union, at - int(w.first[doc]), n, same, union)
                        best[key] = min(best.get(key, new), new)
        for (doc, item), (_, start, n, same, union) in sorted(best.items()):
            yield doc, item, start, n, same, union


def _search(blocks: list[Items]):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        rows = list(leaks_in(texts, blocks))
        if not rows:
            return None
        doc, item, start, n, same, union = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        ids = batch.column("doc_id").take(pa.array(doc))
        return pa.record_batch([ids, pa.array(item), pa.array(start), pa.array(n), pa.array(same / union)], names=["doc_id", "item_id", "start", "n_words", "similarity"])

    return by_chunk(work)


def _scans(items: DataFrame, k: int, percent: int, block_bytes: int, scan_bytes: int) -> Iterator[list[Items]]:
    """The blocks of items of each scan."""
    blocks: list[Items] = []
    ids: list[int] = []
    texts: list[bytes] = []
    size = whole = 0
    for row in items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        t = row.text.encode()
        if texts and size + len(t) > block_bytes:
            blocks.append(Items(ids, texts, k, percent))
            ids, texts, size = [], [], 0
            if whole + len(t) > scan_bytes:
                yield blocks
                blocks, whole = [], 0
        ids.append(row.item_id)
        texts.append(t)
        size += len(t)
        whole += len(t)
    if texts:
        blocks.append(Items(ids, texts, k, percent))
    if blocks:
        yield blocks


def leaks(docs: DataFrame, items: DataFrame, *, k: int = 5, percent: int = 75, block_bytes: int = 1 << 20, scan_bytes: int = 1 << 24) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): each document's best window for each item that it leaks.

    start counts the words before the window.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, start long, n_words long, similarity double"
    out = spark.createDataFrame([], schema)
    for blocks in _scans(items, k, percent, block_bytes, scan_bytes):
        out = out.unionByName(docs.mapInArrow(_search(blocks), schema))
    return out


def _clean(blocks: list[Items]):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        bad = {row[0] for row in leaks_in(texts, blocks)}
        return batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))

    return by_chunk(work)


def without_leaks(docs: DataFrame, items: DataFrame, *, k: int = 5, percent: int = 75, block_bytes: int = 1 << 20, scan_bytes: int = 1 << 24) -> DataFrame:
    """docs less the rows that leak an item; a filter of the scan, once for every ``scan_bytes`` of items."""
    prepare(docs.sparkSession)
    for blocks in _scans(items, k, percent, block_bytes, scan_bytes):
        docs = docs.mapInArrow(_clean(blocks), docs.schema)
    return docs
