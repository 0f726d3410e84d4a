"""Runs of jobs, models and checks: metric rows, latest runs, durations, success rates."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

JOB_METRICS = "run_date date, collected_at timestamp, job_name string, run_id string, status string, duration_seconds long, duration_minutes double, workers int, worker_type string, started_at timestamp, completed_at timestamp, error string"


def metric_rows(spark: SparkSession, runs: Sequence[Mapping], now: datetime.datetime) -> DataFrame:
    """One row per job's last run; a job whose run cannot be read gets status COLLECTION_ERROR."""
    rows = []
    for r in runs:
        seconds = int(r.get("duration_seconds") or 0)
        status = "COLLECTION_ERROR" if "collection_error" in r else r.get("status", "UNKNOWN")
        rows.append((now.date(), now, r["job_name"], r.get("run_id", ""), status, seconds, round(seconds / 60, 1), int(r.get("workers") or 0), r.get("worker_type", ""), r.get("started_at"), r.get("completed_at"), str(r.get("collection_error") or r.get("error") or "")[:500]))
    return spark.createDataFrame(rows, JOB_METRICS)


def append_metrics(rows: DataFrame, path: str) -> None:
    """JSON lines under year=/month=/day=."""
    rows.withColumns({"year": F.year("run_date"), "month": F.month("run_date"), "day": F.dayofmonth("run_date")}).write.mode("append").partitionBy("year", "month", "day").json(path)


def job_durations(runs: DataFrame, keys: Sequence[str] = ("job_name", "run_id")) -> DataFrame:
    """From the first start to the last end of each run."""
    d = runs.groupBy(*keys).agg(F.min("started_at").alias("started_at"), F.max("completed_at").alias("completed_at"))
    return d.withColumn("seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at")))


def invocations(runs: DataFrame, model: str = "model", at: str = "generated_at") -> DataFrame:
    """Each run's number from the newest on, and whether it was its model's first or last of the day."""
    day = W.partitionBy(model, F.to_date(at))
    return runs.withColumns({"reverse_index": F.row_number().over(W.partitionBy(model).orderBy(F.desc(at))), "first_of_day": F.col(at) == F.min(at).over(day), "last_of_day": F.col(at) == F.max(at).over(day)})


def latest(runs: DataFrame, model: str = "model", at: str = "generated_at") -> DataFrame:
    return invocations(runs, model, at).where("reverse_index = 1").drop("reverse_index", "first_of_day", "last_of_day")


def success_rate(results: DataFrame, at: str = "created_at") -> DataFrame:
    """Of the newest run's checks: how many passed or warned, in percent."""
    newest = results.agg(F.max(at).alias("_newest"))
    last = results.join(F.broadcast(newest), results[at] == F.col("_newest"))  # one row
    ok = F.count_if(F.col("status").isin("pass", "warn"))
    return last.agg(F.count("*").alias("checks"), ok.alias("passed"), F.round(F.try_divide(ok * 100.0, F.count("*")), 1).alias("percent"))


def monitor_span(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    return metrics.groupBy(*keys).agg(F.min("bucket_start").alias("first_bucket"), F.max("bucket_end").alias("last_bucket"))


def sensitivity(scores: DataFrame, levels: Sequence[float] = (1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5)) -> DataFrame:
    """Which thresholds a score passes."""
    return scores.withColumns({f"is_anomaly_{str(x).replace('.', '_')}": F.coalesce(F.abs("z") >= x, F.lit(False)) for x in levels})
