"""Toxicity by compression distance: two Zstandard dictionaries, one of toxic and one of ordinary text.

A window is ``WORDS`` words that follow one another, with the blanks around them, in A-Z lower case, and a constant tail
that both dictionaries hold, so that a compressed window has the same overhead with either. A window that the toxic
dictionary compresses shorter holds wording of toxic documents. How many of a text's windows save at least 1, 2, ...
bytes, and which share of them, goes to a logistic function calibrated on the labelled documents.

Both dictionaries come from Zstandard's trainer, on contrasting samples. The ordinary one is trained on windows of
ordinary documents that hold none of the byte runs below. Toxic documents consist of ordinary wording almost everywhere and the trainer would pick just that,
so the toxic one is trained on those words of toxic documents, as often as they stand there, that hold a byte run of
significantly higher document frequency among toxic documents. What is compressed with is the ordinary dictionary with
the toxic one after it, against the ordinary one with as much filler that nothing matches: both work with equal
parameters and offsets, and only the toxic dictionary makes a difference.

A dictionary shortens the very texts that it was trained on more than others. So toxic documents are halved: each half is
calibrated with the dictionary trained on the other one, and texts are scored with the dictionary of both.

Labels are learned from at most ``most`` toxic and twice as many ordinary documents (the least by a hash of doc_id) with
texts up to ``most_bytes``, and the ordinary dictionary is trained on at most ``ORDINARY_WINDOWS`` of their windows:
bounds on the fit alone. Both kinds are counted over all labels that may be learned from, and the calibration weighs the
sample by these counts, so that scores and thresholds do not depend on the bounds. Every whole text is scored; the windows'
savings are remembered, so that a frequent window is compressed once by a worker. Null and empty texts have no window.
Labels, languages, sources and ids are no features. Repeated rows are scored each; a null doc_id is in no fold (held_out is
null); extra columns are ignored. Without labels of both kinds the score is 0.5; without toxic wording in them the score is
their share.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import label_fold, prepare
from sluice.llm.quality import _adam, labelled_sample, score_documents

GRAMS, LEVEL, WORDS = (5, 6, 8), 3, 1
PIECE = 64  #: bytes of a part of a longer window
ORDINARY_BYTES, TOXIC_BYTES, ORDINARY_WINDOWS = 32768, 4096, 60_000
#: The trainer's segments and runs for words; for ordinary text it chooses its own.
SEGMENTS = {"k": 24, "d": 8}
TAIL = b"~^{constant tail of every window}^~"
REMEMBERED = 1_000_000
_TOP = 10


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def windows_of(text: bytes, size: int = 0) -> list[bytes]:
    size, own = size or WORDS, words_of(text)
    return own if size == 1 else [b" ".join(own[i : i + size]) for i in range(0, len(own), size)]


def _grams(b: bytes, size: int) -> np.ndarray:
    a = np.frombuffer(b, np.uint8).astype(np.uint64)
    n = len(a) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        out = (out << np.uint64(8)) | a[i : i + n]
    return out


def _blank(text: bytes) -> bytes:
    return b" " + b" ".join(words_of(text)) + b" "


def _distinctive(toxic: list[bytes], ordinary: list[bytes], size: int, least: int = 5) -> set[int]:
    """Byte runs whose document frequency among toxic texts is surely several times that among ordinary ones."""
    parts = [np.unique(np.concatenate([np.unique(_grams(b, size)) for b in toxic[a : a + 250]]), return_counts=True) for a in range(0, len(toxic), 250)]
    grams = np.unique(np.concatenate([g for g, _ in parts]))
    c = np.zeros(len(grams), np.int64)
    for g, n in parts:
        c[np.searchsorted(grams, g)] += n
    grams, c = grams[c >= least], c[c >= least]
    o = np.zeros(len(grams), np.int64)
    for b in ordinary if len(grams) else ():
        g = np.unique(_grams(b, size))
        at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
        o[at[grams[at] == g]] += 1
    low, high = (c - 2 * np.sqrt(c)) / len(toxic), (o + 2 * np.sqrt(o) + 1) / len(ordinary)
    return set(grams[low >= 4 * high].tolist())


def distinctive_runs(toxic: list[bytes], ordinary: list[bytes]) -> dict[int, np.ndarray]:
    """By length: the byte runs that set toxic texts apart."""
    t, o = [_blank(x) for x in toxic], [_blank(x) for x in ordinary]
    return {size: np.array(sorted(_distinctive(t, o, size)), np.uint64) for size in GRAMS}


def holding(found: list[bytes], runs: dict[int, np.ndarray]) -> np.ndarray:
    """Which words or windows, with a blank at either end, hold one of the runs."""
    out = np.zeros(len(found), bool)
    buffer, ends = b"".join(b" %s " % w for w in found), np.cumsum([len(w) + 2 for w in found])
    for size, own in runs.items():
        if len(own) and found:
            at = np.flatnonzero(np.isin(_grams(buffer, size), own))  # a run over two of them has two blanks: no text does
            out[np.searchsorted(ends, at, "right")] = True
    return out


def contrasting(toxic: list[bytes], runs: dict[int, np.ndarray]) -> list[bytes]:
    """The words of toxic texts that hold a run, with a blank at either end, as often as they stand there.

    They come in a random order: the trainer takes something from each stretch of its samples.
    """
    standing = Counter(w for x in toxic for w in words_of(x))
    different = sorted(standing)
    found = [b" %s " % w for w, h in zip(different, holding(different, runs), strict=True) if h for _ in range(standing[w])]
    return [found[i] for i in np.random.default_rng(1).permutation(len(found))]


def _dictionary(size: int, samples: list[bytes], **options: int) -> bytes:
    """A dictionary trained on samples, over again where they are few; where the trainer still finds them too few, the
    samples by frequency."""
    again = -(-8 * size // max(1, sum(map(len, samples))))
    try:
        return zstandard.train_dictionary(size, samples * max(1, again), **options).as_bytes()
    except zstandard.ZstdError:
        return b"".join(s for s, _ in reversed(Counter(samples).most_common()))[-size:]


def _compressor(content: bytes):
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)


#: What a worker remembers, by model.
_SAVED: dict[bytes, dict[bytes, int]] = {}


class Distance:
    """Two dictionaries and the calibration; compressors are made where they are used."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        filler = np.random.default_rng(0).integers(128, 256, max(TOXIC_BYTES, len(toxic))).astype(np.uint8).tobytes()
        self.contents = (ordinary + filler + b"\x80" + TAIL, ordinary + filler[len(toxic) :] + toxic + b"\x80" + TAIL)
        self.key = hashlib.blake2b(self.contents[1]).digest()
        self.mean = self.scale = self.weights = None
        self.made = None

    def __getstate__(self):
        return self.__dict__ | {"made": None}

    def _saved(self, found: list[bytes]) -> list[int]:
        """Of each window, how many bytes less the toxic dictionary takes; a long window counts as its best part."""
        if self.made is None:
            self.made = [_compressor(c) for c in self.contents]
        parts = [[w[i : i + PIECE] for i in range(0, max(1, len(w) - PIECE // 2), PIECE // 2)] if len(w) > PIECE else [w] for w in found]
        windows = [b" " + p + b" " + TAIL for ps in parts for p in ps]
        lengths = np.fromiter(map(len, windows), np.int64, len(windows))
        if hasattr(self.made[0], "multi_compress_to_buffer"):
            table = np.stack([np.cumsum(lengths) - lengths, lengths], axis=1).astype("<u8").tobytes()
            data = b"".join(windows)
            sizes = [_sizes(c.multi_compress_to_buffer(zstandard.BufferWithSegments(data, table), threads=0)) for c in self.made]
        else:
            sizes = [np.fromiter((len(c.compress(x)) for x in windows), np.int64, len(windows)) for c in self.made]
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.maximum.reduceat(sizes[0] - sizes[1], np.cumsum(n) - n).tolist()

    def savings(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.key not in _SAVED:
            _SAVED.clear()
            _SAVED[self.key] = {}
        known = _SAVED[self.key]
        if len(known) > REMEMBERED:
            known.clear()
        split = [windows_of(t) for t in texts]
        new = list(set().union(*split).difference(known))
        for a in range(0, len(new), 8192):
            known.update(zip(new[a : a + 8192], self._saved(new[a : a + 8192]), strict=True))
        return [np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)) for ws in split]

    def features(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty((len(texts), 2 * _TOP + 1 + 4))
        for i, z in enumerate(self.savings(texts)):
            c = np.cumsum(np.bincount(np.clip(z, 0, _TOP), minlength=_TOP + 1)[::-1])[::-1][1:]
            out[i] = np.concatenate([np.log1p(c), [np.log1p(len(z))], np.sqrt(c / max(1, len(z))), c[1:8:2] > 0])
        return out

    def calibrate(self, x: np.ndarray, labels: np.ndarray, share: float) -> None:
        """x: features of labelled texts; share: of toxic documents among all, whatever it is among them."""
        weight = np.where(labels == 1, share / labels.sum(), (1 - share) / (1 - labels).sum())
        self.mean = weight @ x
        self.scale = np.sqrt(weight @ (x - self.mean) ** 2) + 1e-6
        x = np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)
        self.weights = _adam(np.zeros(x.shape[1]), lambda w: x.T @ (weight * (1 / (1 + np.exp(-np.clip(x @ w, -50, 50))) - labels)) + 1e-4 * w, 400, 0.1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = (self.features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50)))


def _sizes(buffers) -> np.ndarray:
    """Lengths of the compressed windows, in order."""
    return np.fromiter((len(x) for x in buffers), np.int64, len(buffers))


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.value)


def train(docs: DataFrame, labels: DataFrame, learn, *, label: str = "toxic", most: int = 1500, most_bytes: int = 65536):
    texts: dict[int, list[bytes]] = {}
    for value in (0, 1):
        rows = labelled_sample(docs, labels.where(F.col(label) == value), label, learn, most * (2 - value))
        rows = rows.where(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes).select("text").toArrow().column("text").to_pylist()
        texts[value] = sorted({(t or "").encode() for t in rows})  # a text of many copies counts once
    ordinary, toxic = texts[0], texts[1]
    if not ordinary or not toxic:
        return Constant(0.5)
    counted = dict(labels.where(F.col(label).isin(0, 1)).where(learn).groupBy(F.col(label).cast("int")).agg(F.countDistinct("doc_id")).collect())
    share = counted[1] / (counted[0] + counted[1])
    return fitted(toxic, ordinary, share)


def fitted(toxic: list[bytes], ordinary: list[bytes], share: float):
    """The model of distinct toxic and ordinary texts; share: of toxic ones among all."""
    runs = distinctive_runs(toxic, ordinary)
    found = contrasting(toxic, runs)
    if not found:
        return Constant(share)
    pieces = [w for x in ordinary for w in sorted(set(windows_of(x)))]
    taken = [pieces[i] for i in np.random.default_rng(0).permutation(len(pieces))[:ORDINARY_WINDOWS]]
    plain = _dictionary(ORDINARY_BYTES, [b" %s " % w for w, h in zip(taken, holding(taken, runs), strict=True) if not h])
    halves = [contrasting(toxic[i::2], distinctive_runs(toxic[i::2], ordinary[i::2])) for i in (0, 1)]
    model, x = Distance(_dictionary(TOXIC_BYTES, found, **SEGMENTS), plain), []
    for i in (0, 1):
        other = Distance(_dictionary(TOXIC_BYTES, halves[1 - i], **SEGMENTS), plain) if halves[1 - i] else model
        x.append(other.features(toxic[i::2] + ordinary[i::2]))
    labels = [np.repeat([1.0, 0.0], [len(toxic[i::2]), len(ordinary[i::2])]) for i in (0, 1)]
    model.calibrate(np.concatenate(x), np.concatenate(labels), share)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out: int = 2, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of the fold crc32(doc_id) mod folds = held_out are never read."""
    prepare(docs.sparkSession)
    model = train(docs, labels, label_fold("doc_id", folds) != held_out, **options)
    scored = score_documents(docs, model)
    return scored.select("doc_id", (label_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
