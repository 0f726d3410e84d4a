"""Repeated passages by de Bruijn compaction over words.

Every run of k words is an edge of a de Bruijn graph from the node of its first k - 1 words to the node of its last
k - 1. An edge's source coordinate is the smallest (doc_id, start) at which its words stand. Words that any later
occurrence covers are removed; edges are judged on the input.

Plan, for a corpus of any size (no step gathers a group: hot edges and nodes only ever meet as partial aggregates):

1. One pass gives each document its word count, a 128-bit fingerprint of its words and the digest of its words.
   A later document with the very same words repeats whole, so only the first of such a class goes on.
2. Edges are dealt by their minimizer (the least hash of the m-word runs inside; equal edges have equal ones). Only
   minimizers that stand in two places can hold a repeated edge: all others end here, unshuffled.
3. Documents meet their surviving stretches once. Their edges, named by the hashes of both nodes and 32 bits more, are
   reduced to source coordinates and occurrence counts.
4. A node does not branch if one repeated edge enters and one leaves it, as often and in the same place of the same
   source. Edges are joined with such nodes, and maximal runs of joined edges are compacted to paths.
5. Every document joins the paths that begin in it. A surviving edge that is not on one of its own document's paths
   repeats an earlier one.
6. Spans are verified: every surviving stretch is cut at edges that a hash picks, and spans that agree in all their edges
   must agree in the 128-bit digest of their words with the span at the source. Where two differ, edges are hashed anew.

Null, empty and short texts have no edge and keep all words. Rows that repeat a doc_id are told apart by their words;
coordinates are (doc_id, start), so equal coordinates never repeat each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BinaryType

from sluice.llm import words
from sluice.llm.common import appended, by_chunk, fresh, join_hot, prepare, signed, stored, with_column

#: Words of a minimizer run; and one in how many edges cuts a stretch into spans to verify.
MINIMIZER, CUT = 8, 8


def _windows(w: words.Words, k: int) -> np.ndarray:
    """Which word positions begin a k-word run of one text."""
    ok = np.zeros(int(w.first[-1]), bool)
    n = np.maximum(w.counts - k + 1, 0)
    at = np.repeat(w.first[:-1], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    ok[at] = True
    return ok


def _minimizers(w: words.Words, h: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word position: the edge's minimizer (0 where no edge begins), and the hashes of the m-word runs."""
    ok = _windows(w, k)
    small = words.runs(h, m)
    least = np.zeros(len(h), np.uint64)
    slid = words.sliding(small, k - m + 1, np.minimum)
    least[: len(slid)] = slid
    least[~ok] = 0
    return ok, least, small


def fingerprint(text: bytes) -> tuple[int, bytes, bytes]:
    parts = text.split()
    joined = b" ".join(parts)
    return len(parts), hashlib.blake2b(joined, digest_size=16).digest(), joined


def _documents(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    n, fp, sha = [], [], []
    for t in texts:
        count, f, joined = fingerprint(t)
        n.append(count)
        fp.append(f)
        sha.append(hashlib.sha256(joined).hexdigest())
    return pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sha)], names=["doc_id", "n_words", "fp", "sha"])


def _places(k: int, m: int) -> Callable:
    """(h, doc, times): the places of minimizers, by a 64-bit hash of their document's words."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        w = words.split(texts)
        h = w.hashes()
        ok, least, small = _minimizers(w, h, k, m)
        if not ok.any():
            return None
        # a run is a minimizer's place if it is the least of some edge around it, so no less than their greatest minimizer
        padded = np.concatenate((np.zeros(k - m, np.uint64), least[: len(small)]))
        place = np.flatnonzero(small == words.sliding(padded, k - m + 1, np.maximum))
        doc = np.searchsorted(w.first, place, "right") - 1
        value = small[place]
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])))
        at = np.flatnonzero(new)
        times = np.diff(np.concatenate((at, [len(value)])))
        ids = np.array([int.from_bytes(fingerprint(t)[1][:8], "little", signed=True) if c >= k else 0 for t, c in zip(texts, w.counts, strict=True)], np.int64)
        return pa.record_batch([signed(value[at]), pa.array(ids[doc[at]]), pa.array(times > 1)], names=["h", "doc", "twice"])

    return by_chunk(work)


def _stretches(k: int, m: int) -> Callable:
    """(h, doc_id, start, n): edges of one document that follow one another and share a minimizer."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        w = words.split(texts)
        ok, least, _ = _minimizers(w, w.hashes(), k, m)
        at = np.flatnonzero(ok)
        if not len(at):
            return None
        doc = np.searchsorted(w.first, at, "right") - 1
        value = least[at]
        begin = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))))
        n = np.diff(np.concatenate((begin, [len(at)])))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        start = (at - w.first[doc])[begin]
        return pa.record_batch([signed(value[begin]), pa.array(ids[doc[begin]]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], names=["h", "doc_id", "start", "n"])

    return by_chunk(work)


def _marked(batch: pa.RecordBatch, w: words.Words, column: str) -> np.ndarray:
    """Which word positions the (start, n) stretches of each row name."""
    out = np.zeros(int(w.first[-1]) + 1, np.int32)
    col = batch.column(column)
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.flatten()
    if len(flat):
        base, top = np.repeat(w.first[:-1], sizes), np.repeat(w.first[1:], sizes)
        a = np.minimum(base + flat.field("start").to_numpy(), top)
        b = np.minimum(a + flat.field("n").to_numpy(), top)
        np.add.at(out, a, 1)
        np.add.at(out, b, -1)
    return np.cumsum(out)[:-1] > 0


def _hashed_edges(batch: pa.RecordBatch, w: words.Words, k: int, seed: int) -> tuple[np.ndarray, ...]:
    """Positions of the surviving edges, their left and right nodes, and 32 bits more."""
    at = np.flatnonzero(_marked(batch, w, "stretches") & _windows(w, k))
    if not len(at):
        return (at,) * 4
    node = words.runs(w.hashes(seed=seed), k - 1)
    more = (words.runs(w.hashes(seed=seed + 1), k, seed=1)[at] >> np.uint64(32)).astype(np.uint32)
    return at, node[at], node[at + 1], more


def _edges(k: int, seed: int) -> Callable:
    """(a, b, g, doc_id, start, times): each document's distinct surviving edges, where they begin first and how often they stand there."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        w = words.split(texts)
        at, a, b, g = _hashed_edges(batch, w, k, seed)
        if not len(at):
            return None
        doc = np.searchsorted(w.first, at, "right") - 1
        order = np.lexsort((at, g, b, a, doc))
        a, b, g, doc, at = a[order], b[order], g[order], doc[order], at[order]
        same = (doc[1:] == doc[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (g[1:] == g[:-1])
        begin = np.flatnonzero(np.concatenate(([True], ~same)))
        times = np.diff(np.concatenate((begin, [len(at)]))).astype(np.int32)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        return pa.record_batch([signed(a[begin]), signed(b[begin]), pa.array(g[begin].view(np.int32)), pa.array(ids[doc[begin]]), pa.array((at - w.first[doc])[begin].astype(np.int32)), pa.array(times)], names=["a", "b", "g", "doc_id", "start", "times"])

    return by_chunk(work)


def _spans(k: int, seed: int) -> Callable:
    """(edges, words): a hash of the edges of each span between two cuts of a stretch, and the digest of its words."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        w = words.split(texts)
        at, a, b, g = _hashed_edges(batch, w, k, seed)
        if not len(at):
            return None
        edge = words.mix(a ^ words.mix(b ^ g.astype(np.uint64)))
        run = np.cumsum(np.concatenate(([True], np.diff(at) != 1)))  # edges of two texts never follow one another
        cut = np.flatnonzero(edge % np.uint64(CUT) == 0)
        if not len(cut):
            return None
        last = np.concatenate((cut[1:], [0]))
        last[-1] = cut[-1]
        last = np.where(run[last] == run[cut], last, cut)  # a run's last cut is verified by its own words
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(edge * (np.uint64(2) * at.astype(np.uint64) + np.uint64(1)))))
        plain = np.concatenate((np.zeros(1, np.uint64), np.cumsum(edge)))
        # sum of edge * (2 * place + 1), where a span's first edge has place 0
        named = total[last + 1] - total[cut] - np.uint64(2) * at[cut].astype(np.uint64) * (plain[last + 1] - plain[cut])
        named = words.mix(named ^ words.mix(edge[cut] + (last - cut).astype(np.uint64)))
        buffer = w.buffer.tobytes()
        first, end = w.starts[at[cut]].tolist(), w.ends[at[last] + k - 1].tolist()
        digests = [hashlib.blake2b(b" ".join(buffer[x:y].split()), digest_size=16).digest() for x, y in zip(first, end, strict=True)]
        return pa.record_batch([signed(named), pa.array(digests, pa.binary())], names=["edges", "words"])

    return by_chunk(work)


def clashes(spans: DataFrame) -> DataFrame:
    """Spans (edges, words) of equal edges and different words."""
    return spans.groupBy("edges").agg(F.min("words").alias("least"), F.max("words").alias("most")).where("least <> most")


def _kept(k: int) -> Callable:
    """(doc_id, fp, n_removed, kept): documents that lose words, by their stretches and the paths that begin in them."""

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch | None:
        w = words.split(texts)
        n = int(w.first[-1])
        again = _marked(batch, w, "stretches") & _windows(w, k) & ~_marked(batch, w, "paths")
        cover = np.zeros(n + k, np.int32)
        cover[:n] += again
        cover[k:] -= again
        gone = np.cumsum(cover)[:n] > 0
        ids, fps, lost, kept = [], [], [], []
        for i, t in enumerate(texts):
            own = gone[w.first[i] : w.first[i + 1]]
            if own.any():
                ids.append(batch.column("doc_id")[i].as_py())
                fps.append(fingerprint(t)[1])
                lost.append(int(own.sum()))
                kept.append(b" ".join(x for x, g in zip(t.split(), own, strict=True) if not g))
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(fps, pa.binary()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "fp", "n_removed", "kept"])

    return by_chunk(work)


def sources(edges: DataFrame) -> DataFrame:
    """(a, b, doc_id, start, occurrences) of each edge of (a, b, g, doc_id, start, times)."""
    return edges.groupBy("a", "b", "g").agg(F.min("doc_id").alias("doc_id"), F.expr("min_by(start, doc_id)").alias("start"), F.sum("times").alias("occurrences")).drop("g")


def through_nodes(repeated: DataFrame) -> DataFrame:
    """(node) of the nodes that do not branch: one edge enters, one leaves, as often, and they follow one another in their source."""
    enters = repeated.select(F.col("b").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"), "doc_id", (F.col("start") + 1).alias("at"), "occurrences")
    leaves = repeated.select(F.col("a").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"), "doc_id", F.col("start").alias("at"), "occurrences")
    same = [f"min({c}) = max({c})" for c in ("doc_id", "at", "occurrences")]
    return enters.unionByName(leaves).groupBy("node").agg(F.expr(f"sum(i) = 1 and sum(o) = 1 and {' and '.join(same)}").alias("through")).where("through").select("node")


def first_paths(edges: DataFrame) -> DataFrame:
    """Compacts edges (a, b, doc_id, start, occurrences) to paths (doc_id, start, n, occurrences).

    A path is a maximal run of repeated edges over nodes that do not branch, or of neighbouring edges that stand once.
    """
    repeated = edges.where("occurrences > 1")
    joined = repeated.join(through_nodes(repeated), F.col("a") == F.col("node"), "left").select("doc_id", "start", "occurrences", F.col("node").isNotNull().alias("goes_on"))
    once = edges.where("occurrences = 1").select("doc_id", "start", "occurrences", F.lit(False).alias("goes_on"))
    inside = W.partitionBy("doc_id").orderBy("start")
    placed = joined.unionByName(once).withColumn("before", F.lag(F.when(F.col("occurrences") == 1, F.col("start"))).over(inside))
    head = ~F.col("goes_on") & ~((F.col("occurrences") == 1) & F.coalesce(F.col("before") == F.col("start") - 1, F.lit(False)))
    numbered = placed.select("doc_id", "start", "occurrences", F.sum(head.cast("int")).over(inside).alias("path"))
    return numbered.groupBy("doc_id", "path").agg(F.min("start").alias("start"), F.count("*").cast("int").alias("n"), F.min("occurrences").alias("occurrences")).drop("path")


def repeats(docs: DataFrame, *, k: int = 20, m: int = MINIMIZER) -> tuple[DataFrame, DataFrame]:
    """Of docs (doc_id, text): all rows' (doc_id, n_words, fp, sha), and (doc_id, fp, n_removed, kept) of those that lose words."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stored(docs.mapInArrow(by_chunk(_documents), "doc_id long, n_words long, fp binary, sha string"), "documents")
    classes = known.where(F.col("n_words") >= k).groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))

    places = docs.mapInArrow(_places(k, m), "h long, doc long, twice boolean")
    again = places.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.max(F.col("twice").cast("int")).alias("twice")).where("a <> b or twice = 1").select("h")
    again = stored(again, "minimizers")
    stretches = docs.mapInArrow(_stretches(k, m), "h long, doc_id long, start int, n int").join(again, "h", "left_semi")
    by_doc = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("stretches"))
    by_doc = stored(by_doc.join(classes.select("doc_id").distinct(), "doc_id", "left_semi"), "stretches")

    touched = stored(docs.join(by_doc.hint("shuffle_hash"), "doc_id"), "touched")
    for seed in itertools.count(step=2):
        if clashes(touched.mapInArrow(_spans(k, seed), "edges long, words binary")).isEmpty():
            break
    edges = stored(sources(touched.mapInArrow(_edges(k, seed), "a long, b long, g int, doc_id long, start int, times int")), "edges")
    paths = stored(first_paths(edges).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("paths")), "paths")
    joined = touched.join(paths, "doc_id", "left").select("doc_id", "text", "stretches", F.coalesce("paths", F.array().cast("array<struct<start:int,n:int>>")).alias("paths"))
    changed = joined.mapInArrow(_kept(k), "doc_id long, fp binary, n_removed long, kept string")
    first = classes.where("copies > 1").select("fp", F.col("doc_id").alias("first_id"))
    copies = join_hot(known.where(F.col("n_words") >= k), first, "fp", "inner").where("doc_id <> first_id").select("doc_id", "fp", F.col("n_words").alias("n_removed"), F.lit("").alias("kept"))
    return known, stored(changed.unionByName(copies).dropDuplicates(["doc_id", "fp"]), "changed")


def passage_digests(docs: DataFrame, *, k: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of docs."""
    known, changed = repeats(docs, k=k)
    out = known.join(changed, ["doc_id", "fp"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


def without_repeats(docs: DataFrame, *, k: int = 20) -> DataFrame:
    """docs with the text of each document that loses words replaced by its kept words, joined by one space."""
    _, changed = repeats(docs, k=k)
    key, of, doc, kept = fresh(docs, "_fp", "_of", "_id", "_kept")
    marked = docs.mapInArrow(appended(lambda _, texts: pa.array([fingerprint(t)[1] for t in texts], pa.binary()), key), with_column(docs, key, BinaryType()))
    small = changed.select(F.col("doc_id").alias(doc), F.col("fp").alias(of), F.col("kept").alias(kept))
    joined = marked.join(small, (marked["doc_id"] == small[doc]) & (marked[key] == small[of]), "left")
    return joined.select(*[F.coalesce(small[kept], marked["text"]).alias("text") if c == "text" else marked[c] for c in docs.columns])
