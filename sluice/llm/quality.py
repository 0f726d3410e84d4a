"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad. A line's features (character classes, word lengths, repetition inside the line,
and whether the line stood in the text before) count together with those of the lines beside it; a transition weight
ties neighbours. The field is fitted by maximum likelihood with the document's label as the label of its lines, and the
length-weighted mean of the lines' forward-backward marginals, calibrated by a logistic function, is the document's
score.

Chains of all documents of a batch are run at once by a logarithmic scan of 2 x 2 matrix products; a document's
first line has a matrix that forgets what came before. So a text of any number of lines costs no Python loop. A text of
over a MiB goes by pieces of its lines, with the same result: the whole chain is run over what features sum up to.

Labels are learned from at most ``most`` labelled documents (the least by a hash of doc_id) of at most ``most_lines``
lines each: the only bound here, and one on the fit alone. Scoring reads every whole text. Null and empty texts are
one empty line. Labels, languages, sources and ids are no features. Repeated rows are scored each; a null doc_id is in no
fold (held_out is null); extra columns are ignored. Without any usable label the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sluice.llm import words
from sluice.llm.common import appended, by_chunk, fresh, label_fold, prepare, with_column
from sluice.llm.words import SLAB

_CLASS = np.full(256, 7, np.uint8)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:'\"()-?", b"!", b"|")):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 8
_CLASS[:32], _CLASS[9], _CLASS[10] = 9, 3, 10
_CLASSES = 11


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, its length in bytes, and how many lines each text has."""
    return _line_features(texts)[:3]


def _line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """And a hash of each line's words."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    per_text = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
    ends = np.flatnonzero(buffer == 10)
    n = len(ends)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lens = ends - starts
    counts = np.zeros((n, _CLASSES))
    for a in range(0, len(buffer), SLAB):  # what is held by character is bounded, however long a line
        b = min(a + SLAB, len(buffer))
        i, j = np.searchsorted(ends, a), np.searchsorted(ends, b - 1) + 1
        of = np.repeat(np.arange(j - i), np.minimum(ends[i:j] + 1, b) - np.maximum(starts[i:j], a)) * _CLASSES
        counts[i:j] += np.bincount(of + _CLASS[buffer[a:b]], minlength=(j - i) * _CLASSES).reshape(j - i, _CLASSES)
    counts = counts[:, :9]
    w = words.split(texts)
    h = w.hashes(lower=True)
    line = np.searchsorted(ends, w.starts)
    n_words = np.bincount(line, minlength=n).astype(np.float64)
    again = np.zeros(len(h), bool)
    if len(h):
        again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line, weights=again, minlength=n)
    pairs = np.unique(words.mix(h ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)[1]
    distinct = np.bincount(line[pairs], minlength=n)
    total = np.cumsum(np.concatenate((np.zeros(1, np.uint64), words.mix(h + (np.arange(len(h), dtype=np.uint64) - np.concatenate((np.zeros(1), np.cumsum(n_words)))[line].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)))))
    bound = np.concatenate((np.zeros(1, np.int64), np.cumsum(n_words).astype(np.int64)))
    whole = total[bound[1:]] - total[bound[:-1]]
    doc = np.repeat(np.arange(len(texts)), per_text)
    order = np.lexsort((np.arange(n), whole, doc))
    before = np.zeros(n)
    before[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]]) & (n_words[order[1:]] > 0)
    length, some = np.maximum(lens, 1), np.maximum(n_words, 1)
    letters = counts[:, 0] + counts[:, 1]
    f = np.column_stack([
        counts / length[:, None],
        np.log1p(lens), np.log1p(n_words), lens / some / 10, counts[:, 1] / (letters + 1),
        np.minimum(counts[:, 5:8].sum(axis=1) / some, 4), repeats / some, distinct / some, before, n_words == 0, n_words == 1,
        np.minimum(counts[:, 6] / some, 2), counts[:, 8] / (letters + counts[:, 8] + 1),
    ])
    return f, lens.astype(np.float64), per_text, whole


def _pieces(text: bytes, most: int):
    """Runs of whole lines of about ``most`` bytes; a longer line is one."""
    at = 0
    while at <= len(text):
        end = text.find(b"\n", min(at + most, len(text)))
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def with_neighbours(f: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after (none at a text's ends), and a bias."""
    first = np.cumsum(per_text) - per_text
    last = first + per_text - 1
    prev, nxt = np.zeros_like(f), np.zeros_like(f)
    prev[1:], nxt[:-1] = f[:-1], f[1:]
    prev[first], nxt[last] = 0, 0
    edge = np.zeros((len(f), 2))
    edge[first, 0] = edge[last, 1] = 1
    return np.concatenate([f, prev, nxt, edge, np.ones((len(f), 1))], axis=1)


def _scan(m: np.ndarray) -> np.ndarray:
    """Running products m[0] @ ... @ m[i] of 2 x 2 matrices, each up to a factor."""
    m = m.copy()
    step = 1
    while step < len(m):
        a, b = m[:-step], m[step:]
        p = np.empty_like(b)
        for i in range(2):
            for j in range(2):
                p[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
        p /= p.sum(axis=(1, 2), keepdims=True)
        m[step:] = p
        step *= 2
    return m


def marginals(unary: np.ndarray, transition: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(line is good), and the (2, 2) probabilities of each line's label with the one before (zero at first lines)."""
    first = np.cumsum(per_text) - per_text
    last = first + per_text - 1
    half = np.clip(unary, -60, 60) / 2
    psi = np.exp(np.stack([-half, half], axis=1))
    t = np.exp(transition)
    forward = t[None] * psi[:, None, :]
    forward[first] = psi[first][:, None, :]
    forward /= forward.sum(axis=(1, 2), keepdims=True)
    alpha = _scan(forward)[:, 0, :]
    alpha /= alpha.sum(axis=1, keepdims=True)
    # beta[i] = t @ (psi[i + 1] * beta[i + 1]); at a text's last line it is 1 again
    back = np.empty_like(forward)
    back[:-1] = t[None] * psi[1:, None, :]
    back[last] = 1
    back = np.swapaxes(back[::-1], 1, 2)
    back = back / back.sum(axis=(1, 2), keepdims=True)
    beta = _scan(back)[::-1].sum(axis=1)
    beta /= beta.sum(axis=1, keepdims=True)
    node = alpha * beta
    node /= node.sum(axis=1, keepdims=True)
    pair = np.zeros((len(unary), 2, 2))
    pair[1:] = alpha[:-1, :, None] * t[None] * (psi[1:] * beta[1:])[:, None, :]
    pair[1:] /= pair[1:].sum(axis=(1, 2), keepdims=True)
    pair[first] = 0
    return node[:, 1], pair


def long_marginals(unary: np.ndarray, transition: np.ndarray, size: int = 1 << 16) -> np.ndarray:
    """P(line is good) of one text, ``size`` lines at a time."""
    n, t = len(unary), np.exp(transition)
    psi = lambda a, b: np.exp(np.clip(unary[a:b, None], -60, 60) / 2 * np.array([-1.0, 1.0]))
    alpha, carry = np.empty((n, 2)), np.ones(2)
    for a in range(0, n, size):
        b = min(a + size, n)
        m = t[None] * psi(a, b)[:, None, :]
        if a == 0:
            m[0] = psi(0, 1)[0]
        own = carry @ _scan(m / m.sum(axis=(1, 2), keepdims=True))
        alpha[a:b] = own / own.sum(axis=1, keepdims=True)
        carry = alpha[b - 1]
    out, after = np.empty(n), np.ones(2)
    for a in range((n - 1) // size * size, -1, -size):
        b = min(a + size, n)
        beta = np.empty((b - a, 2))
        beta[-1] = after
        if b - a > 1:
            m = np.swapaxes((t[None] * psi(a + 1, b)[:, None, :])[::-1], 1, 2)
            beta[:-1] = (after @ _scan(m / m.sum(axis=(1, 2), keepdims=True)))[::-1]
        beta /= beta.sum(axis=1, keepdims=True)
        both = alpha[a:b] * beta
        out[a:b] = both[:, 1] / both.sum(axis=1)
        after = t @ (psi(a, a + 1)[0] * beta[0])
        after /= after.sum()
    return out


#: Place of the feature that a line stood in the text before.
_BEFORE = 16


class Field:
    """The fitted field: feature scales, weights, transitions and the score's calibration."""

    def __init__(self, mean, scale, weights, transition, a=1.0, b=0.0):
        self.mean, self.scale, self.weights, self.transition, self.a, self.b = mean, scale, weights, transition, a, b

    def good(self, f: np.ndarray, lens: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Length-weighted share of good lines of each text, as log odds."""
        x = with_neighbours((f - self.mean) / self.scale, per_text)
        p, _ = marginals(x @ self.weights, self.transition, per_text)
        first = np.cumsum(per_text) - per_text
        weight = lens + 1
        share = np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share))

    def good_long(self, text: bytes, most: int) -> float:
        """The same of one long text: features by pieces of lines, then the chain of all its lines."""
        d = len(self.mean)
        by_place = self.weights[: 3 * d].reshape(3, d).T
        sums, lens, seen = [], [], np.zeros(0, np.uint64)
        for piece in _pieces(text, most):
            f, n, _, whole = _line_features([piece])
            f[:, _BEFORE] = np.maximum(f[:, _BEFORE], np.isin(whole, seen) & (f[:, _BEFORE + 1] == 0))
            seen = np.union1d(seen, whole)
            sums.append(((f - self.mean) / self.scale) @ by_place)
            lens.append(n)
        own, before, after = np.concatenate(sums).T
        unary = own + self.weights[-1]
        unary[1:] += before[:-1]
        unary[:-1] += after[1:]
        unary[0] += self.weights[-3]
        unary[-1] += self.weights[-2]
        weight = np.concatenate(lens) + 1
        share = np.clip((long_marginals(unary, self.transition) * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        return float(np.log(share / (1 - share)))

    def score(self, texts: list[bytes], most: int = SLAB) -> np.ndarray:
        good = np.empty(len(texts))
        long = np.fromiter((len(t) > most for t in texts), bool, len(texts))
        if not long.all():
            good[~long] = self.good(*line_features([t for t, x in zip(texts, long, strict=True) if not x]))
        good[long] = [self.good_long(t, most) for t, x in zip(texts, long, strict=True) if x]
        return 1 / (1 + np.exp(-(self.a * good + self.b)))


def _adam(x: np.ndarray, gradient: Callable, steps: int, rate: float) -> np.ndarray:
    m = v = np.zeros_like(x)
    for i in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return x


def logistic(z: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """a, b of P(y) = 1 / (1 + exp(-(a z + b)))."""
    scale = max(float(np.abs(z).mean()), 1e-6)
    x = np.stack([z / scale, np.ones_like(z)], axis=1)
    w = _adam(np.array([1.0, 0.0]), lambda w: x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -50, 50))) - y) / len(y) + 1e-3 * w * [1, 0], steps, 0.1)
    return float(w[0] / scale), float(w[1])


def fit(f: np.ndarray, lens: np.ndarray, per_text: np.ndarray, labels: np.ndarray, steps: int = 120) -> Field:
    mean, scale = f.mean(axis=0), f.std(axis=0) + 1e-3
    x = with_neighbours((f - mean) / scale, per_text)
    y = np.repeat(labels, per_text).astype(float)
    share = 1 / np.repeat(per_text, per_text)  # every document counts alike
    d = x.shape[1]
    second = np.ones(len(x), bool)
    second[np.cumsum(per_text) - per_text] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[second].astype(int), y[second].astype(int)), share[second])

    def gradient(w):
        p, pair = marginals(x @ w[:d], w[d:].reshape(2, 2), per_text)
        g = x.T @ ((p - y) * share)
        t = (pair * share[:, None, None]).sum(axis=0) - seen
        return np.concatenate([g, t.ravel()]) / len(labels) + 1e-4 * w

    w = _adam(np.zeros(d + 4), gradient, steps, 0.1)
    field = Field(mean, scale, w[:d], w[d:].reshape(2, 2))
    field.a, field.b = logistic(field.good(f, lens, per_text), labels.astype(float))
    return field


def _line_rows(most_lines: int) -> Callable:
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        keep = [i for i, t in enumerate(texts) if t.count(b"\n") < most_lines]
        if not keep:
            return None
        f, lens, per_text = line_features([texts[i] for i in keep])
        cut = np.cumsum(per_text) - per_text
        part = lambda a: [x.tobytes() for x in np.split(a, cut[1:])]
        return pa.record_batch([batch.column("label").take(pa.array(keep)).cast(pa.int32()), pa.array(part(f.astype(np.float32)), pa.binary()), pa.array(part(lens), pa.binary())], names=["label", "f", "lens"])

    return by_chunk(work)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, text, label) of docs whose label is 0 or 1 and for which ``learn`` holds.

    Of rows that repeat a doc_id one is taken (the least by a hash of its text), so what is gathered is bounded.
    """
    own = labels.where(F.col(label).isin(0, 1)).where(learn).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("label"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # no more rows than the parameter, so a bounded broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(own), "doc_id")
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("_text"))
    return rows.withColumn("_text", F.xxhash64("text")).withColumn("_place", place).where("_place = 1").drop("_text", "_place")


def train(docs: DataFrame, labels: DataFrame, learn, *, label: str = "quality", most: int = 3000, most_lines: int = 400) -> Field | None:
    rows = labelled_sample(docs, labels, label, learn, most).mapInArrow(_line_rows(most_lines), "label int, f binary, lens binary").toArrow()
    y = rows.column("label").to_numpy()
    if len(np.unique(y)) < 2:
        return None
    lens = [np.frombuffer(x, np.float64) for x in rows.column("lens").to_pylist()]
    f = np.frombuffer(b"".join(rows.column("f").to_pylist()), np.float32).astype(np.float64)
    per_text = np.array([len(x) for x in lens])
    return fit(f.reshape(int(per_text.sum()), -1), np.concatenate(lens), per_text, y)


def _score(model, texts: list[bytes]) -> pa.Array:
    return pa.array(model.score(texts) if model is not None else np.full(len(texts), 0.5))


def _scores(model) -> Callable:
    return by_chunk(lambda batch, texts: pa.record_batch([batch.column("doc_id"), _score(model, texts)], names=["doc_id", "score"]))


def score_documents(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) for each row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scores(model), "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held_out: int = 1, threshold: float = 0.5, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of the fold crc32(doc_id) mod folds = held_out are never read."""
    prepare(docs.sparkSession)
    model = train(docs, labels, label_fold("doc_id", folds) != held_out, **options)
    scored = score_documents(docs, model)
    return scored.select("doc_id", (label_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held_out: int = 1, threshold: float = 0.5, **options) -> DataFrame:
    """docs less those whose score is under the threshold."""
    prepare(docs.sparkSession)
    model = train(docs, labels, label_fold("doc_id", folds) != held_out, **options)
    (score,) = fresh(docs, "_score")
    scored = docs.mapInArrow(appended(lambda _, texts: _score(model, texts), score), with_column(docs, score, DoubleType()))
    return scored.where(F.col(score) >= threshold).drop(score)
