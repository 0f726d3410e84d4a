"""Nearest neighbours by inner product with multi-probe p-stable hashing.

Equal vectors are one class, which keeps its ``k + 1`` least ids: no query can want more of them, and a vector that a
third of all rows hold is one row from here on. Classes are dealt to ranges of norm (the greatest of a range is at most
``STEP`` times the least) and put on their range's sphere (one more component, sqrt(greatest norm**2 - norm**2)), so that
within a range the largest inner product is the smallest distance.

A table hashes a vector by ``bits`` Gaussian projections, each cut into cells of ``WIDTH`` of which one bound lies at the
median of a sample; the Gaussian axes of all tables are made orthogonal, so that tables do not ask the same twice. A query
visits cells in the order of their estimated success: given the cosine at which the k-th neighbour among that many
unclustered rows stands, a neighbour's projection is normal about that part of the query's own, and each coordinate that
leaves its likelier cell for the one beyond the nearer bound costs its log odds. Its first ``probes`` cells are those
whose costs sum up to a threshold, so a query takes only the threshold with it. How many these are follows from the
number of rows, of components and of tables (``probe_share``): the share shrinks as rows grow.

Rows and queries meet by (range, table, cells of the first axes): a real join on buckets. Where a group has more than
``block`` rows or ``query_block`` queries it is split, and parts meet parts. Within a group the visited cells are looked
up among its buckets, and only their rows are compared, by exact inner products of the original vectors in double
precision. What all tables found is merged by query.

Ranges of at most ``WHOLE`` classes are searched whole. So is, for one query, a range of which vectors at a cosine under
``FLOOR`` times the one that probing was laid out for would still be among its best, and every range where fewer than k
were found: hashing does not tell those from others.

Null vectors, zero vectors and those with a null or non-finite component or another length than most take no part. A
row's own id is never its neighbour; ties go to the smaller id. Rows that agree in id and vector are one candidate, rows
of one id with different vectors are candidates each. A query row that is repeated gets its own k rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import prepare, stored

TABLES, BITS, WIDTH = 4, 16, 4.0
STEP, FLOOR, WHOLE, TARGET = 1.1, 0.85, 256, 0.92
#: Most axes of a table, and vectors of the sample that cell bounds are fitted on (the least by hash).
MOST_BITS, SAMPLE = 28, 4096
_NORMAL = NormalDist()


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v as the source has it, or doubles; vectors that take no part are left out."""
    kind = "array<float>" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(good, F.lit(False)))


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, without overflow."""
    most = np.abs(x).max(axis=1, keepdims=True, initial=0)
    return most[:, 0] * np.sqrt(((x / most) ** 2).sum(axis=1))


def probe_share(n: int, k: int, dim: int, bits: int, tables: int, target: float = TARGET) -> tuple[float, float]:
    """The cosine of the k-th of n unclustered neighbours, and the share of a table's cells to visit for it."""
    z = _NORMAL.inv_cdf(1 - min(0.5, k / n))
    missed = (1 - target) ** (1 / tables)
    at = np.sqrt(2 * bits / (np.pi * max(dim, bits))) * z + _NORMAL.inv_cdf(missed)
    return max(z, 0.1) / np.sqrt(dim), 1 - _NORMAL.cdf(at)


@dataclass
class Range:
    radius: float
    bits: int
    split: int  #: axes that name a group
    cosine: float
    probes: int


def _odds(x: np.ndarray) -> np.ndarray:
    """log(P / (1 - P)) of a normal's value under x."""
    x = np.minimum(x, 30)
    return 1.5976 * x + 0.07056 * x**3


def threshold(costs: np.ndarray, probes: int) -> float:
    """The ``probes``-th least sum of a subset of costs."""
    half = len(costs) // 2
    sums = []
    for part in (costs[:half], costs[half:]):
        s = np.zeros(1)
        for c in part:
            s = np.concatenate((s, s + c))
        sums.append(np.sort(s))
    a, b = sums
    low, high = 0.0, float(a[-1] + b[-1])
    if probes >= len(a) * len(b):
        return high * (1 + 1e-12)
    for _ in range(40):
        middle = (low + high) / 2
        if np.searchsorted(b, middle - a, "right").sum() >= probes:
            high = middle
        else:
            low = middle
    return high


def subsets(costs: np.ndarray, steps: np.ndarray, start: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """start plus the steps of each subset whose costs are at most limit in sum, and the sums."""
    s, key = np.zeros(1), np.array([start], np.int64)
    for j in np.argsort(-costs):
        more = s + costs[j]
        keep = more <= limit
        s, key = np.concatenate((s, more[keep])), np.concatenate((key, key[keep] + steps[j]))
    return key, s


class Scheme:
    """Axes, cell bounds and ranges: what rows and queries are hashed by."""

    def __init__(self, dim: int, tables: int, bits: int, seed: int, ranges: dict[int, Range], sample: np.ndarray):
        self.dim, self.tables, self.ranges = dim, tables, ranges
        rng = np.random.default_rng(seed)
        most, own = max([bits, *(r.bits for r in ranges.values())]), []
        while sum(len(a) for a in own) < tables * most:  # a random basis of Gaussian axes, then the next
            own.append(np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0].T * np.sqrt(dim))
        axes = np.concatenate(own)
        first, more = axes[: tables * bits].reshape(tables, bits, dim + 1), axes[tables * bits : tables * most].reshape(tables, most - bits, dim + 1)
        self.axes = np.concatenate([first, more], axis=1)
        self.shift = np.zeros((tables, most))
        if len(sample):
            radius = np.sqrt((sample * sample).sum(axis=1))
            self.shift = -np.median(self.axes @ np.concatenate([sample / radius[:, None], np.zeros((len(sample), 1))], axis=1).T, axis=2)

    def _places(self, x: np.ndarray, radius: float | np.ndarray, table: int, bits: int) -> np.ndarray:
        """(row, axis): projections, a cell bound at zero."""
        unit = x / np.reshape(radius, (-1, 1))
        last = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
        return np.concatenate([unit, last[:, None]], axis=1) @ self.axes[table, :bits].T + self.shift[table, :bits]

    def keys(self, x: np.ndarray, r: int, table: int) -> np.ndarray:
        own = self.ranges[r]
        cells = np.clip(np.floor(self._places(x, own.radius, table, own.bits) / WIDTH), -2, 1).astype(np.int64) + 2
        return (cells << (2 * np.arange(own.bits))).sum(axis=1)

    def probing(self, q: np.ndarray, norm: np.ndarray, r: int, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query the likeliest cell's key, and each axis's cost of and step to the cell beyond."""
        own = self.ranges[r]
        c = min(own.cosine, 0.99)
        places = self._places(q, norm, table, own.bits)
        middle = self.shift[table, : own.bits]
        expected = (places - middle) * c + middle
        bound = np.clip(np.rint(places / WIDTH), -1, 1)
        gap = expected - bound * WIDTH
        up = gap >= 0
        cost = _odds(np.abs(gap) / np.sqrt(1 - c * c))
        unit = np.int64(1) << (2 * np.arange(own.bits, dtype=np.int64))
        likely = bound.astype(np.int64) + 2 - ~up
        return (likely * unit).sum(axis=1), cost, np.where(up, -unit, unit)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


_KEYS = "array<struct<range:int,part:int,bucket_group:long,key:long>>"
_PROBES = "array<struct<range:int,part:int,bucket_group:long,limit:double>>"


def _measured(dim: int) -> Callable:
    """Adds to classes (vh, v, ids) their norm and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                norm = norms(_matrix(batch.column("v"), dim))
                of = np.ceil(np.log(norm) / np.log(STEP) - 1e-6).astype(np.int32)
                yield pa.record_batch([*(batch.column(c) for c in ("vh", "v", "ids")), pa.array(norm), pa.array(of)], names=["vh", "v", "ids", "norm", "range"])

    return run


def _hash_rows(scheme: Scheme) -> Callable:
    """Adds to classes (vh, v, ids, norm, range) their keys: one for each table, or the pool of small ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, of = _matrix(batch.column("v"), scheme.dim), batch.column("range").to_numpy()
            out: list = [[{"range": -1, "part": -1, "bucket_group": 0, "key": 0}]] * len(x)
            for r in np.unique(of).tolist():
                if r in scheme.ranges:
                    at = np.flatnonzero(of == r)
                    mask = (1 << (2 * scheme.ranges[r].split)) - 1
                    keys = [scheme.keys(x[at], r, t).tolist() for t in range(scheme.tables)]
                    for i, row in zip(at, zip(*keys, strict=True), strict=True):
                        out[i] = [{"range": r, "part": t, "bucket_group": key & mask, "key": key} for t, key in enumerate(row)]
            kind = pa.list_(pa.struct([("range", pa.int32()), ("part", pa.int32()), ("bucket_group", pa.int64()), ("key", pa.int64())]))
            yield pa.record_batch([batch.column(c) for c in ("vh", "v", "ids", "range")] + [pa.array(out, kind)], names=["vh", "v", "ids", "range", "keys"])

    return run


def _hash_queries(scheme: Scheme, pool: bool) -> Callable:
    """Adds to queries (n, id, v) their norm and the groups that they visit, each with the sum of costs that is left for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("v"), scheme.dim)
            norm = norms(q)
            out: list = [[{"range": -1, "part": -1, "bucket_group": 0, "limit": 0.0}] if pool else [] for _ in q]
            for r, own in scheme.ranges.items():
                mask = (1 << (2 * own.split)) - 1
                for t in range(scheme.tables):
                    key, cost, step = scheme.probing(q, norm, r, t)
                    for i in range(len(q)):
                        limit = threshold(cost[i], own.probes)
                        groups, spent = subsets(cost[i, : own.split], step[i, : own.split], int(key[i]) & mask, limit)
                        out[i] += [{"range": r, "part": t, "bucket_group": g, "limit": limit - s} for g, s in zip(groups.tolist(), spent.tolist(), strict=True)]
            kind = pa.list_(pa.struct([("range", pa.int32()), ("part", pa.int32()), ("bucket_group", pa.int64()), ("limit", pa.float64())]))
            yield pa.record_batch([batch.column(c) for c in ("n", "id", "v")] + [pa.array(norm), pa.array(out, kind)], names=["n", "id", "v", "norm", "probes"])

    return run


class Block:
    """Rows of a group, by bucket."""

    def __init__(self, table: pa.Table, dim: int, k: int):
        key = table.column("key").to_numpy()
        order = np.argsort(key, kind="stable")
        self.x, self.k, self.vh = _matrix(table.column("v"), dim)[order], k, table.column("vh").to_numpy()[order]
        ids = table.column("ids").combine_chunks().take(pa.array(order))
        self.ids, self.first = ids.flatten().to_numpy(), np.concatenate(([0], np.cumsum(np.diff(ids.offsets.to_numpy()))))
        self.known, self.begin = np.unique(key[order], return_index=True)
        self.end = np.concatenate((self.begin[1:], [len(key)]))

    def visited(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the buckets with these keys."""
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        at = at[self.known[at] == keys]
        begin, n = self.begin[at], self.end[at] - self.begin[at]
        return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))

    def best(self, q: np.ndarray, own: int, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vec_id, vh, score) of the k nearest among rows, nearest first."""
        x = self.x if rows is None else self.x[rows]
        rows = np.arange(len(x)) if rows is None else rows
        if len(rows) > self.k + 1:
            product = x @ q
            least = np.partition(product, -self.k - 1)[-self.k - 1]
            keep = product >= least - 1e-9 * abs(least)
            x, rows = x[keep], rows[keep]
        score = (x * q).sum(axis=1)  # the same order of additions whatever the block
        n = self.first[rows + 1] - self.first[rows]
        ids = self.ids[np.repeat(self.first[rows] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        score, vh = np.repeat(score, n), np.repeat(self.vh[rows], n)
        other = ids != own
        ids, score, vh = ids[other], score[other], vh[other]
        order = np.lexsort((ids, -score))[: self.k]
        return ids[order], vh[order], score[order]


_FOUND = "n long, query_id long, vec_id long, vh long, score double"


def _search(scheme: Scheme, k: int) -> Callable:
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            r, t, code = (key[i].as_py() for i in range(3))
            block, q = Block(right, scheme.dim, k), _matrix(left.column("v"), scheme.dim)
            if t >= 0:
                split = scheme.ranges[r].split
                first, cost, step = scheme.probing(q, left.column("norm").to_numpy(), r, t)
                low = first & ~np.int64((1 << (2 * split)) - 1)
            for i, (n, own, limit) in enumerate(zip(*(left.column(c).to_pylist() for c in ("n", "id", "limit")), strict=True)):
                rows = None
                if t >= 0:
                    keys, _ = subsets(cost[i, split:], step[i, split:], int(low[i]) + code, limit)
                    rows = block.visited(keys)
                    if not len(rows):
                        continue
                ids, vh, score = block.best(q[i], own, rows)
                out.append((np.full(len(ids), n), np.full(len(ids), own), ids, vh, score))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
        return pa.table({"n": pa.array(cols[0], pa.int64()), "query_id": pa.array(cols[1], pa.int64()), "vec_id": pa.array(cols[2], pa.int64()), "vh": pa.array(cols[3], pa.int64()), "score": pa.array(cols[4], pa.float64())})

    return run


_GROUP = ["range", "part", "bucket_group"]


def _meet(asked: DataFrame, classes: DataFrame, work: Callable, block: int, query_block: int) -> DataFrame:
    """What queries (n, id, v, norm, limit) and rows (vh, v, ids, key) of one group give, part against part."""
    queries, rows = asked.groupBy(*_GROUP).agg(F.ceil(F.count("*") / query_block).cast("int").alias("qs")), classes.groupBy(*_GROUP).agg(F.ceil(F.count("*") / block).cast("int").alias("rs"))
    parts = stored(queries.join(rows, _GROUP), "groups")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = asked.join(parts, _GROUP).select(*_GROUP, "n", "id", "v", "norm", "limit", F.pmod(F.xxhash64("n"), F.col("qs")).cast("int").alias("qb"), every("rs").alias("rb"))
    right = classes.join(parts, _GROUP).select(*_GROUP, "vh", "v", "ids", "key", F.pmod("vh", F.col("rs")).cast("int").alias("rb"), every("qs").alias("qb"))
    by = [*_GROUP, "qb", "rb"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(work, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """Each query's k best of what was found, perhaps in several tables."""
    once = found.groupBy("n", "query_id", "vec_id", "vh").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("n").orderBy(F.desc("score"), "vec_id", "vh")).alias("rank")
    return once.select("*", rank).where(F.col("rank") <= k)


def nearest(rows: DataFrame, queries: DataFrame, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, bits: int = BITS, target: float = TARGET, block: int = 65536, query_block: int = 2048, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k nearest found in rows, nearest first."""
    spark = rows.sparkSession
    prepare(spark)
    index = usable(rows, id_col, vector_col)
    sizes = index.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sizes[0].dim
    asked = usable(queries, id_col, vector_col).where(F.size("v") == dim).select(F.monotonically_increasing_id().alias("n"), "id", "v")
    place = F.dense_rank().over(W.partitionBy("v").orderBy("id"))
    classes = index.where(F.size("v") == dim).withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    kind = index.schema["v"].dataType.simpleString()
    classes = classes.select(F.xxhash64("v").alias("vh"), "v", "ids").mapInArrow(_measured(dim), f"vh long, v {kind}, ids array<long>, norm double, range int")
    classes = stored(classes, "classes")

    ranges = {}
    for r, n, radius in classes.groupBy("range").agg(F.count("*"), F.max("norm")).collect():  # of doubles there are under 15,000 ranges
        if n > max(WHOLE, 2 * k):
            own = min(MOST_BITS, max(bits, (n - 1).bit_length()))
            cosine, share = probe_share(n, k, dim, own, tables, target)
            ranges[r] = Range(radius, own, max(0, (-(-n // block) - 1).bit_length()), cosine, max(own + 1, round(share * 2**own)))
    pool = bool(classes.where(~F.col("range").isin(*ranges)).limit(1).count()) if ranges else True
    sample = classes.where(F.col("range").isin(*ranges)).orderBy("vh").limit(SAMPLE).select("v").toArrow() if ranges else None
    scheme = Scheme(dim, tables, bits, seed, ranges, _matrix(sample.column("v"), dim) if sample else np.zeros((0, dim)))

    classes = stored(classes.mapInArrow(_hash_rows(scheme), f"vh long, v {kind}, ids array<long>, range int, keys {_KEYS}"), "hashed")
    asked = stored(asked.mapInArrow(_hash_queries(scheme, pool), f"n long, id long, v {kind}, norm double, probes {_PROBES}"), "queries")
    left = asked.select("n", "id", "v", "norm", F.explode("probes").alias("p")).select("n", "id", "v", "norm", "p.*")
    right = classes.select("vh", "v", "ids", F.explode("keys").alias("p")).select("vh", "v", "ids", "p.*")
    best = stored(_merged(_meet(left, right, _search(scheme, k), block, query_block), k), "found")

    if ranges:  # what hashing does not tell apart
        reached = best.groupBy("n").agg(F.count("*").alias("found"), F.min("score").alias("least"))
        bounds = F.array(*[F.struct(F.lit(r).alias("range"), F.lit(FLOOR * own.cosine * own.radius).alias("bound")) for r, own in ranges.items()])
        unsure = lambda x: F.col("found").isNull() | (F.col("found") < k) | (F.col("least") < x["bound"] * F.col("norm"))
        again = asked.join(reached, "n", "left").select("n", "id", "v", "norm", F.explode(F.filter(bounds, unsure)).alias("r"))
        again = again.select("n", "id", "v", "norm", "r.range", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bucket_group"), F.lit(0.0).alias("limit"))
        if not again.isEmpty():
            whole = classes.where(F.col("range").isin(*ranges)).select("vh", "v", "ids", "range", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bucket_group"), F.lit(0).cast("long").alias("key"))
            more = _meet(again, whole, _search(scheme, k), block, query_block)
            best = _merged(best.drop("rank").unionByName(more), k)
    return best.select("query_id", "rank", "vec_id", "score")
