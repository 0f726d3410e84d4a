"""What the operators of this subpackage share: written tables, batches and hashes."""

from __future__ import annotations

import atexit
import gc
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Rows of one Arrow batch of texts; a batch is cut further by bytes (CHUNK_BYTES).
BATCH_ROWS = "512"
CHUNK_BYTES = 1 << 21

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where it is unset (tests), a folder of this machine."""
    sc = spark.sparkContext
    told = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not told:
        told = tempfile.mkdtemp(prefix="sluice-")
        sc.setCheckpointDir(told)
    return told


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


#: Tables that this process has written and not yet removed.
_WRITTEN: list[str] = []


def release(spark: SparkSession) -> None:
    """Removes the tables written so far; no DataFrame made from them may be used any more. Done at the process's end."""
    while _WRITTEN:
        try:
            hadoop, fs = _file_system(spark, _WRITTEN.pop())
            fs.delete(hadoop, True)
        except Exception:  # the session ended first
            return


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under the checkpoint folder and read again: lineage ends there, and a lost
    executor costs no more than the reading of its files. Shuffle files that nothing refers to are let go."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/sluice/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _WRITTEN:
        atexit.register(release, spark)
    _WRITTEN.append(path)
    schema = df.schema
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


#: A key is hot if it holds more than one in so many rows: there are fewer hot keys than this, whatever the data.
HOT = 256


def join_hot(rows: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """rows joined with small, which has one row a key; a left join keeps null keys.

    Keys that hold over one in HOT rows are under HOT in number: they are found by a count and joined by broadcast, so no
    task gets all rows of a hot key. All others are left to the planner.
    """
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    total = rows.count()
    hot = [r[0] for r in counted.where(F.col("count") > max(total // HOT, 256)).select(key).collect()]
    none = rows.where(F.col(key).isNull())
    if not hot:
        out = rows.where(F.col(key).isNotNull()).join(small, key, how)
    else:
        is_hot = F.col(key).isin(hot)
        out = rows.where(~is_hot).join(small.where(~is_hot), key, how).unionByName(rows.where(is_hot).join(F.broadcast(small.where(is_hot)), key, how))
    return out.unionByName(none, allowMissingColumns=True) if how == "left" else out


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df does not have, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_column(df: DataFrame, name: str, kind: DataType) -> StructType:
    """df's schema and one more column."""
    return StructType([*df.schema.fields, StructField(name, kind)])


def prepare(spark: SparkSession) -> None:
    """Makes this package known to the Python workers and keeps a batch of texts that goes to one small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_sluice_shipped", False):
        return
    root, made = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = f"{checkpoint_dir(spark).rstrip('/')}/sluice/code-{uuid.uuid4().hex}/sluice_package.zip"
    hadoop, fs = _file_system(spark, path)
    out = fs.create(hadoop, True)
    try:
        out.write(bytearray(made.getvalue()))
    finally:
        out.close()
    sc.addPyFile(str(fs.makeQualified(hadoop)))
    sc._sluice_shipped = True


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes at most; a longer text is a range of its own."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def appended(values: Callable[[pa.RecordBatch, list[bytes]], pa.Array], name: str, text: str = "text"):
    """An Arrow map that appends a column of values(rows, texts), by bounded pieces of each batch."""
    return by_chunk(lambda rows, texts: rows.append_column(name, values(rows, texts)), text)


def by_chunk(work: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch], text: str = "text"):
    """An Arrow map that calls work(rows, texts) for bounded pieces of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = utf8(batch.column(text))
            for a, b in chunks(texts):
                out = work(batch.slice(a, b - a), texts[a:b])
                if out is not None and out.num_rows:
                    yield out

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def label_fold(doc_id: str, n: int):
    """crc32(doc_id as text) mod n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n)
