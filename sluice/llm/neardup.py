"""Near duplicates by circulant MinHash, with exact Jaccard verification and connected components.

A document's set holds the distinct k-word shingles of its whole text (the whole sequence where it has fewer
words). Two permutations give every signature coordinate: ``sigma`` spreads the shingle hashes over 2**32 places
once, and coordinate ``j`` is the least ``pi`` of the places shifted circularly by ``j``. Bands of coordinates
bring candidates together.

Plan, for a corpus of any size:

1. One pass gives each document its set's size, a 128-bit fingerprint of the set and the band keys. Documents with
   equal sets are one class from here on, so a group of copies costs one row.
2. Within a bucket only links to its least and its greatest member are tried (a star, never all pairs), and
   verified on full sets. Components follow.
3. Only buckets that still hold more than one component are looked at again: each member outside the bucket's
   largest component against all others, under conditions that are exact bounds of the similarity (set sizes, and
   shingles that no other candidate has). What passes is verified on full sets, in a large bucket block against
   block inside tasks, and components are joined. Thus no candidate of the bands is lost and no pair inside one component is ever made.

Empty, null and blank texts have an empty set and link with nothing. Repeated rows of one doc_id are one document
for the links (one of several texts links by any of them); each row is returned. A row of a null doc_id links with nothing that has one: its component and kept are
null. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import words
from sluice.llm.common import by_chunk, join_hot, lists, mix, prepare, signed, stored
from sluice.llm.graph import components

BANDS, ROWS = 32, 4
#: Members of a bucket that are compared as rows of pairs at most, and of a block in a larger bucket.
SMALL, BLOCK = 32, 256
_SIGMA, _PI1, _PI2 = np.uint64(0x2545F4914F6CDD1D), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_BLOCK = 2048


def signature(sets: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of one set of 64-bit hashes: min over the set of pi((sigma(x) - j) mod 2**32)."""
    places = (mix(sets ^ _SIGMA) >> np.uint64(32)).astype(np.uint32)
    shift = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(places), _BLOCK):
        x = places[None, a : a + _BLOCK] - shift
        x ^= x >> np.uint32(16)
        x *= _PI1
        x ^= x >> np.uint32(13)
        x *= _PI2
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + least[r::rows].astype(np.uint64))
    return h


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    w = words.split(texts)
    sh, sizes = words.shingles(w, w.hashes(lower=True), k)
    cut = np.concatenate(([0], np.cumsum(sizes)))
    return [np.unique(sh[cut[i] : cut[i + 1]]) for i in range(len(texts))]


def _signatures(k: int, bands: int, rows: int) -> Callable:
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        keys, n, fps = [], [], []
        for s in _sets(texts, k):
            n.append(len(s))
            if len(s):
                keys.append(band_keys(signature(s, bands * rows), bands, rows))
                fps.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            else:
                fps.append(None)
        sizes = np.where(np.array(n) > 0, bands, 0)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        return pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fps, pa.binary()), lists(signed(flat), sizes)], names=["doc_id", "n_shingles", "fp", "bands"])

    return by_chunk(work)


def _set_rows(k: int) -> Callable:
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array([s.tobytes() for s in _sets(texts, k)], pa.binary())], names=["doc_id", "members"])

    return by_chunk(work)


def _linked(percent: int) -> Callable:
    """Keeps the rows (a, b, members_a, members_b) with 100 * |intersection| >= percent * |union|."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                same = int((y[at] == x).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            out = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if out.num_rows:
                yield out

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    b = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("members_b"))
    a = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("members_a"))
    both = pairs.join(b, "b").join(a, "a")
    return both.select("a", "b", "members_a", "members_b").mapInArrow(_linked(percent), "a long, b long")


def _candidate_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, members): each text's set; a doc_id of several texts has several, and links by any of them."""
    rows = docs.join(ids, "doc_id", "left_semi").mapInArrow(_set_rows(k), "doc_id long, members binary")
    return rows.withColumn("_print", F.xxhash64("members")).dropDuplicates(["doc_id", "_print"]).drop("_print")


def _sizes_fit(x, y, percent: int):
    """|intersection| <= the smaller size and |union| >= the larger one."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 75, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    component_id is the least doc_id that links of ``percent`` similarity reach. A pair at exactly 75 % shares a
    band with probability 1 - (1 - .75**4)**32 > 0.999994.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stored(docs.mapInArrow(_signatures(k, bands, rows), "doc_id long, n_shingles long, fp binary, bands array<long>"), "signatures")

    classes = stored(sig.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")), "classes")
    whole = sig.where("n_shingles > 0").select("doc_id", "fp", "n_shingles", "bands")
    reps = whole.join(classes.withColumnsRenamed({"fp": "rep_fp"}), (F.col("doc_id") == F.col("rep")) & (F.col("fp") == F.col("rep_fp")))
    rows_by_key = reps.select("rep", "n", F.explode("bands").alias("key")).distinct()
    shared = rows_by_key.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("members")).where("members > 1")
    buckets = stored(rows_by_key.join(shared, "key"), "buckets")

    star = buckets.select(F.explode(F.array("low", "high")).alias("a"), F.col("rep").alias("b"), F.col("n")).where("a <> b")
    star = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    size = classes.select(F.col("rep"), "n")
    star = star.join(size.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
    star = stored(star.where(_sizes_fit(F.col("na"), F.col("nb"), percent)).select("a", "b"), "star")

    ids = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(_candidate_sets(docs, ids, k), "sets")
    links = stored(_verified(star, sets, percent), "links")
    nodes = components(links)

    links2 = stored(_completion(buckets, nodes, sets, percent), "links2")
    if not links2.isEmpty():
        nodes = components(links.unionByName(links2))

    reached = classes.join(nodes.select(F.col("node").alias("rep"), "component"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = join_hot(sig.select("doc_id", "n_shingles", "fp"), stored(reached, "reached"), "fp")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _completion(buckets: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket, under exact bounds of their similarity.

    A small bucket's candidates are rows of pairs. A large one's are compared inside tasks, a block of members against a
    block of others, so that a group of many unlike members never becomes rows of pairs.
    """
    at = buckets.join(nodes.select(F.col("node").alias("rep"), "component"), "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    by_comp = at.groupBy("key", "comp").agg(F.count("*").alias("c"))
    top = by_comp.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1").select("key", F.col("top.comp").alias("top"))
    mixed = stored(at.join(top, "key"), "mixed")
    # shingles that at least one other candidate has: an upper bound of any intersection
    members = sets.join(mixed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(_explode_members, "doc_id long, h long")
    unique = members.groupBy("h").agg(F.count("*").alias("df"), F.min("doc_id").alias("doc_id")).where("df = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    x = mixed.join(unique.select(F.col("doc_id").alias("rep"), "alone"), "rep", "left").withColumn("s", F.col("n") - F.coalesce("alone", F.lit(0))).where(100 * F.col("s") >= percent * F.col("n"))
    x = stored(x.withColumn("lone", F.col("comp") != F.col("top")), "bounded")
    count = x.groupBy("key").agg(F.count("*").alias("c"), F.count_if("lone").alias("cl")).where("c > 1 and cl > 0")

    few = x.join(count.where(F.col("c") <= SMALL).select("key"), "key", "left_semi")
    a = few.where("lone").select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"), F.col("comp").alias("ca"))
    b = few.select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"), F.col("comp").alias("cb"), "lone")
    most = F.least("sa", "sb")
    pairs = a.join(b, "key").where((F.col("ca") != F.col("cb")) & (~F.col("lone") | (F.col("a") < F.col("b"))) & _sizes_fit(F.col("na"), F.col("nb"), percent) & (100 * most >= percent * (F.col("na") + F.col("nb") - most)))
    links = _verified(stored(pairs.select("a", "b").distinct(), "pairs"), sets, percent)

    many = x.join(count.where(F.col("c") > SMALL), "key").select("key", "rep", "comp", "lone", F.ceil(F.col("cl") / BLOCK).cast("int").alias("x_blocks"), F.ceil(F.col("c") / BLOCK).cast("int").alias("y_blocks"))
    block = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    own = many.where("lone").select("key", block(F.col("x_blocks")).alias("xb"), F.explode(every(F.col("y_blocks"))).alias("yb"), "rep", "comp", F.lit(True).alias("x"))
    others = many.select("key", F.explode(every(F.col("x_blocks"))).alias("xb"), block(F.col("y_blocks")).alias("yb"), "rep", "comp", F.lit(False).alias("x"))
    dealt = own.unionByName(others).join(sets.select(F.col("doc_id").alias("rep"), "members"), "rep")
    return links.unionByName(dealt.groupBy("key", "xb", "yb").applyInArrow(_block_links(percent), "a long, b long").distinct())


def _block_links(percent: int) -> Callable:
    """Links of a block of lone members (x) with a block of others: for each x one link to each other component."""

    def run(table: pa.Table) -> pa.Table:
        rep, comp, x = (table.column(c).to_numpy() for c in ("rep", "comp", "x"))
        sets = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
        n = np.array([len(s) for s in sets])
        _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), n)
        shared = times > 1
        column = np.cumsum(shared) - 1
        keep = shared[place]
        row, place = row[keep], column[place[keep]]
        ix, iy = np.flatnonzero(x), np.flatnonzero(~x)
        same = np.zeros((len(ix), len(iy)), np.float32)
        position = np.empty(len(sets), np.int64)
        position[ix], position[iy] = np.arange(len(ix)), np.arange(len(iy))
        for c in range(0, int(shared.sum()), 4096):  # columns of the sets' matrices, a few at a time
            now = (place >= c) & (place < c + 4096)
            left, right = np.zeros((len(ix), 4096), np.float32), np.zeros((len(iy), 4096), np.float32)
            r, p = row[now], place[now] - c
            of_x = x[r]
            left[position[r[of_x]], p[of_x]] = 1
            right[position[r[~of_x]], p[~of_x]] = 1
            same += left @ right.T
        same = same.astype(np.int64)
        linked = (100 * same >= percent * (n[ix][:, None] + n[iy][None, :] - same)) & (comp[ix][:, None] != comp[iy][None, :])
        i, j = np.nonzero(linked)
        if len(i):
            _, first = np.unique(np.stack([rep[ix[i]], comp[iy[j]]]), axis=1, return_index=True)
            i, j = i[first], j[first]
        a, b = rep[ix[i]], rep[iy[j]]
        return pa.table({"a": np.minimum(a, b).astype(np.int64), "b": np.maximum(a, b).astype(np.int64)})

    return run


def _explode_members(batches):
    for batch in batches:
        for doc, m in zip(batch.column("doc_id"), batch.column("members"), strict=True):
            h = np.frombuffer(m.as_py(), np.int64)
            yield pa.record_batch([pa.array(np.full(len(h), doc.as_py(), np.int64)), pa.array(h)], names=["doc_id", "h"])
