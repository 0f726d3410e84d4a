"""Sharding by extendible hashing.

A document's hash is 60 bits of the MD5 of its id and its text's MD5, so rows of one id spread. A bucket is a prefix of
those bits; beginning with the empty prefix, a bucket of more than ``limit`` bytes splits on one more bit until every
shard fits. Only oversized buckets split, so the directory holds prefixes of different depths.

The directory is made from counts alone: bytes are summed in cells of a few bits more than the total calls for, and
from them, some depths at a time, in all shorter prefixes. A prefix that fits and whose parent does not is a shard, and is
laid out as its cells, through which documents find it (cells of many documents by broadcast). Only documents in cells
that are themselves oversized are looked at again with more bits. Texts are read once for their size and hash and never
shuffled; sums are combined before every shuffle.

A text above the limit is a shard of its own (``oversized``), as are rows that agree in id and text and together exceed
it: no hash tells them apart. Null ids and null texts hash as empty ones. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh, join_hot, stored

BITS = 60
#: Depths of prefixes that are summed at a time.
STEP = 6


def _prefix(depth: int) -> Column:
    return F.shiftright("h", BITS - depth)


def _hash() -> Column:
    own = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(own, 1, 15), 16, 10).cast("long")


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, h): each row's size and its 60 hash bits."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), _hash().alias("h"))


def _sums(cells: DataFrame, low: int, high: int) -> DataFrame:
    """(depth, prefix, bytes, docs) of all prefixes from ``low`` to ``high`` bits of cells (prefix, bytes, docs) of
    ``high`` bits. ``STEP`` depths are made at a time from the sums of the depth below them, so that no prefix gets more
    than 2**STEP rows."""
    out = None
    while True:
        top = max(low, high - STEP)
        up = cells.select("prefix", "bytes", "docs", F.explode(F.sequence(F.lit(top), F.lit(high))).alias("depth"))
        up = up.groupBy("depth", F.expr(f"shiftright(prefix, {high} - depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        part = stored(up, "sums")
        out = part if out is None else out.unionByName(part.where(F.col("depth") < high))
        if top == low:
            return out
        cells, high = part.where(F.col("depth") == top).drop("depth"), top


def _settle(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """(cell, depth, bytes, docs) of each cell of ``high`` bits: its shortest prefix of at least ``low`` bits that fits;
    depth is null where even the cell does not.

    A prefix that fits is a shard if its parent does not fit; a shard is then laid out as the cells under it.
    """
    cells = rows.groupBy(_prefix(high).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    sums = _sums(stored(cells, "sizes"), low, high)
    full = sums.where(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fits = sums.where(F.col("bytes") <= limit).withColumn("parent", F.shiftright("prefix", 1))
    top = fits.where(F.col("depth") == low)
    below = fits.where(F.col("depth") > low).join(full, ["depth", "parent"], "left_semi")
    leaves = top.unionByName(below).select("depth", "bytes", "docs", F.expr(f"shiftleft(prefix, {high} - depth)").alias("first"))
    held = leaves.select("depth", "bytes", "docs", F.explode(F.expr(f"sequence(first, first + shiftleft(1L, {high} - depth) - 1)")).alias("cell"))
    whole = sums.where((F.col("depth") == high) & (F.col("bytes") > limit)).select(F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("long").alias("docs"), F.col("prefix").alias("cell"))
    return held.unionByName(whole).select("cell", "depth", "bytes", "docs")


def _placed(docs: DataFrame, limit: int, spare: int) -> DataFrame:
    """(doc_id, n_bytes, h, depth, bytes, docs) for each row of docs."""
    rows = stored(hashed(docs), "hashes")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, math.ceil(math.log2(max(1, total / limit))) + spare)
    left, out = rows, None
    while True:
        cells = stored(_settle(left, limit, low, high), "cells")
        placed = join_hot(left.withColumn("cell", _prefix(high)), cells, "cell", "inner").drop("cell")
        done = placed.where("depth is not null")
        open_cells = cells.where("depth is null").select("cell")
        last = high == BITS or open_cells.isEmpty()
        if last:
            whole = placed.where("depth is null").drop("depth", "bytes", "docs")
            sums = whole.groupBy("h").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
            done = done.unionByName(join_hot(whole, sums, "h", "inner").withColumn("depth", F.lit(BITS)))
        out = done if out is None else out.unionByName(done)
        if last:
            break
        left = stored(placed.where("depth is null").drop("depth", "bytes", "docs"), "open")
        low, high = high + 1, min(BITS, high + 8)
    return out


def _name() -> Column:
    """A shard's prefix as a string of depth bits."""
    return F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin(F.expr(f"shiftright(h, {BITS} - depth)")), F.col("depth"), F.lit("0")))


def shards(docs: DataFrame, limit: int, *, spare: int = 4) -> DataFrame:
    """(doc_id, n_bytes, depth, prefix, shard_bytes, shard_docs, oversized) for each row of docs (doc_id, text).

    prefix is the shard's hash prefix as a string of depth bits.
    """
    out = _placed(docs, limit, spare)
    return out.select("doc_id", "n_bytes", "depth", _name().alias("prefix"), F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"), (F.col("bytes") > limit).alias("oversized"))


def directory(sharded: DataFrame) -> DataFrame:
    """(prefix, depth, shard_bytes, shard_docs): one row per shard."""
    return sharded.groupBy("prefix", "depth", "shard_bytes", "shard_docs").agg(F.max("oversized").alias("oversized"))


def write_shards(docs: DataFrame, limit: int, path: str, *, spare: int = 4) -> DataFrame:
    """Writes docs by shard (a Hive partition ``shard`` each) under path and returns the directory.

    Rows are told apart by id and text: those that agree in both lie in one shard, and every row is written once. A
    column ``shard`` of docs gives way to the partition's.
    """
    made = stored(_placed(docs, limit, spare), "shards")
    (key,) = fresh(docs, "_row")
    rows = made.select(F.col("h").alias(key), F.concat(F.lit("s"), _name()).alias("shard")).distinct()
    joined = join_hot(docs.drop("shard").withColumn(key, _hash()), rows, key, "inner").drop(key)
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
    sums = made.groupBy("depth", _name().alias("prefix"), "bytes", "docs").agg(F.lit(True))
    return sums.select("prefix", "depth", F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"), (F.col("bytes") > limit).alias("oversized"))


def oracle(limit: int, deepest: int = 26) -> str:
    """The same assignment in DuckDB SQL, for tables that need no more than ``deepest`` bits."""
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
p AS (SELECT depth, h >> ({BITS} - depth)::BIGINT AS prefix, sum(n_bytes)::BIGINT AS bytes, count(*) AS docs
  FROM d, range(0, {deepest + 1}) t(depth) GROUP BY ALL),
s AS (SELECT d.doc_id, d.n_bytes, d.h, p.depth, p.bytes, p.docs,
  row_number() OVER (PARTITION BY d.doc_id, d.h ORDER BY p.depth) AS r
  FROM d, p WHERE p.prefix = d.h >> ({BITS} - p.depth)::BIGINT AND (p.bytes <= {limit} OR p.depth = {deepest}))
SELECT doc_id, n_bytes, depth::INT AS depth,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> ({BITS} - depth)::BIGINT), depth::INT, '0') END AS prefix,
  bytes AS shard_bytes, docs AS shard_docs, bytes > {limit} AS oversized
FROM s WHERE r = 1"""
