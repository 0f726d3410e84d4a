"""Bronze increments as a stream: late and repeated documents end in an idempotent upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.clean import latest
from sluice.operators.snapshot import SnapshotTable


def json_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """New JSON files as they come, with the file that each row is from."""
    return spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).json(path).withColumn("_source_file", F.col("_metadata.file_path"))


def upsert_stream(rows: DataFrame, table: SnapshotTable, keys: Sequence[str], checkpoint: str, *, clean: Callable[[DataFrame], DataFrame] = lambda df: df, order: Sequence[str] = ("_source_file",)) -> StreamingQuery:
    """Upserts each micro-batch: a batch that is run again after a failure leaves the same table."""

    def apply(batch: DataFrame, _: int) -> None:
        one = latest(clean(batch), keys, list(order))
        if not one.isEmpty():
            table.upsert(one, keys)

    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, keys: Sequence[str], *, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts by event-time window; a row that comes later than the watermark is left out."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    counts = events.withWatermark(ts, late).groupBy(w.alias("_w"), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, "n")


def sessions(events: DataFrame, ts: str, keys: Sequence[str], *, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    s = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("_w"), *keys).agg(F.count("*").alias("n"))
    return s.select(F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *keys, "n")
