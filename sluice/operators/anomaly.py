"""Monitors and anomaly scores over time buckets."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def buckets(spark: SparkSession, first: datetime.datetime, end: datetime.datetime, hours: int = 24) -> DataFrame:
    """(bucket_start, bucket_end) of the complete buckets between first and end."""
    start = F.explode(F.sequence(F.lit(first), F.lit(end), F.expr(f"INTERVAL {hours} HOURS"))).alias("bucket_start")
    return spark.range(1).select(start).withColumn("bucket_end", F.col("bucket_start") + F.expr(f"INTERVAL {hours} HOURS")).where(F.col("bucket_end") <= F.lit(end))


def bucket_of(ts: str, first: datetime.datetime, hours: int = 24) -> Column:
    """A row's bucket by arithmetic: an equality join instead of a range join."""
    n = F.floor(F.timestamp_diff("SECOND", F.lit(first), F.col(ts)) / F.lit(hours * 3600))
    return F.timestamp_add("HOUR", (n * hours).cast("int"), F.lit(first))


def volume(df: DataFrame, ts: str, first: datetime.datetime, end: datetime.datetime, hours: int = 24) -> DataFrame:
    """(bucket_start, bucket_end, metric_value): rows by bucket, empty ones 0."""
    counts = df.groupBy(bucket_of(ts, first, hours).alias("bucket_start")).agg(F.count("*").alias("n"))
    return buckets(df.sparkSession, first, end, hours).join(counts, "bucket_start", "left").select("bucket_start", "bucket_end", F.coalesce("n", F.lit(0)).cast("double").alias("metric_value"))


def dimension_volume(df: DataFrame, ts: str, dimension: str, first: datetime.datetime, end: datetime.datetime, hours: int = 24) -> DataFrame:
    """Rows by dimension value and bucket; a value's empty buckets count 0 from its first appearance on."""
    counts = df.groupBy(F.col(dimension).alias("dimension_value"), bucket_of(ts, first, hours).alias("bucket_start")).agg(F.count("*").alias("n"))
    begun = counts.groupBy("dimension_value").agg(F.min("bucket_start").alias("begun"))
    grid = begun.select("dimension_value", F.explode(F.sequence("begun", F.lit(end - datetime.timedelta(hours=hours)), F.expr(f"INTERVAL {hours} HOURS"))).alias("bucket_start"))
    return grid.join(counts, ["dimension_value", "bucket_start"], "left").select("dimension_value", "bucket_start", F.coalesce("n", F.lit(0)).cast("double").alias("metric_value"))


def freshness(df: DataFrame, ts: str, first: datetime.datetime, end: datetime.datetime, hours: int = 24) -> DataFrame:
    """(bucket_start, metric_value): the longest time between updates that ended in a bucket, in seconds.

    A lag over all updates would need one task. The time before a bucket's first update reaches back to the newest one
    of earlier buckets, and buckets are few, so lags run within buckets and over one row per bucket.
    """
    at = df.select(F.col(ts).cast("timestamp").alias("t"), bucket_of(ts, first, hours).alias("bucket_start")).distinct()
    gap = F.unix_micros("t") - F.unix_micros(F.lag("t").over(W.partitionBy("bucket_start").orderBy("t")))
    inner = at.withColumn("gap", gap).groupBy("bucket_start").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.max("gap").alias("gap"))
    before = F.unix_micros("low") - F.unix_micros(F.lag("high").over(W.orderBy("bucket_start")))
    longest = inner.withColumn("metric_value", F.coalesce(F.greatest("gap", before), F.lit(0)) / 1e6)
    return longest.where((F.col("bucket_start") >= F.lit(first)) & (F.col("bucket_start") <= F.lit(end - datetime.timedelta(hours=hours)))).select("bucket_start", "metric_value")


def scores(metrics: DataFrame, order: str, *, keys: Sequence[str] = (), value: str = "metric_value", least: int = 7, sensitivity: float = 3.0, direction: str = "both", ignore_below_percent: float | None = None) -> DataFrame:
    """metrics with training_avg, training_stddev, training_size, z and is_anomalous.

    A point's training set is itself and all before it in its series. No deviation: z is 0; too few points to have one:
    null. direction: both, spike or drop. A change of less than ``ignore_below_percent`` of the average is none.
    """
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    x, avg, dev = F.col(value), F.col("training_avg"), F.col("training_stddev")
    df = metrics.withColumns({"training_avg": F.avg(value).over(w), "training_stddev": F.stddev_samp(value).over(w), "training_size": F.count(value).over(w)})
    df = df.withColumn("z", F.when(dev == 0, 0.0).otherwise(F.try_divide(x - avg, dev)))
    far = {"both": F.abs("z") > sensitivity, "spike": F.col("z") > sensitivity, "drop": F.col("z") < -sensitivity}[direction]
    if ignore_below_percent is not None:
        far = far & (F.abs(x - avg) >= F.abs(avg) * ignore_below_percent / 100)
    return df.withColumn("is_anomalous", F.coalesce((F.col("training_size") >= least) & far, F.lit(False)))


def _percent(part: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, F.nullif(F.count("*"), F.lit(0))), 3)


def numeric_monitors(c: str) -> dict[str, Column]:
    x = F.col(c)
    nulls, zeros = F.count_if(x.isNull()), F.count_if(x.isNull() | (x == 0))
    return {
        "null_count": nulls.cast("double"), "null_percent": _percent(nulls), "not_null_percent": _percent(F.count(c)), "zero_count": zeros.cast("double"), "zero_percent": _percent(zeros), "not_zero_percent": _percent(F.count("*") - zeros),
        "min": F.min(c).cast("double"), "max": F.max(c).cast("double"), "sum": F.sum(x.cast("decimal(18,4)")).cast("double"), "average": F.try_divide(F.sum(x.cast("decimal(18,4)")).cast("double"), F.count(c)), "standard_deviation": F.stddev_samp(c), "variance": F.var_samp(c),
    }


def string_monitors(c: str) -> dict[str, Column]:
    missing = F.count_if(F.trim(F.coalesce(c, F.lit(""))) == "")
    return {"missing_count": missing.cast("double"), "missing_percent": _percent(missing), "not_missing_percent": _percent(F.count("*") - missing), "min_length": F.min(F.length(c)).cast("double"), "max_length": F.max(F.length(c)).cast("double"), "average_length": F.avg(F.length(c))}


def boolean_monitors(c: str) -> dict[str, Column]:
    true = F.count_if(F.coalesce(F.col(c), F.lit(False)))
    return {"count_true": true.cast("double"), "count_false": (F.count("*") - true).cast("double")}


def newest_metrics(history: DataFrame) -> DataFrame:
    """One row per metric and bucket: the newest collected."""
    keys = ["full_table_name", "column_name", "metric_name", "bucket_start", "bucket_end", "dimension", "dimension_value"]
    return history.groupBy(*keys).agg(F.max_by("metric_value", "updated_at").alias("metric_value"), F.max("updated_at").alias("updated_at"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Each model's runs with their rank, and whether they were the first or the last of their day."""
    w = W.partitionBy("model").orderBy(F.desc("started_at"))
    day = W.partitionBy("model", F.to_date("started_at"))
    return runs.withColumns({"run_rank": F.row_number().over(w), "is_first_of_day": F.col("started_at") == F.min("started_at").over(day), "is_last_of_day": F.col("started_at") == F.max("started_at").over(day)})
