"""Exploratory aggregates: what plots need, as DataFrames."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.aggregates import total


def null_shares(df: DataFrame) -> DataFrame:
    """(column, nulls, percent) from one pass."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])).alias("r")
    return one.select("_n", rows).select("r.column", "r.nulls", F.round(F.try_divide(F.col("r.nulls") * 100.0, F.col("_n")), 4).alias("percent"))


def histogram(df: DataFrame, c: str, bins: int, low: float, high: float) -> DataFrame:
    """(bucket, n, mean) over [low, high); 0 and bins + 1 hold what lies outside."""
    return df.where(F.col(c).isNotNull()).groupBy(F.width_bucket(F.col(c).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bucket")).agg(F.count("*").alias("n"), F.try_divide(total(c), F.count("*")).alias("mean"))


def box(df: DataFrame, c: str, groups: Sequence[str] = ()) -> DataFrame:
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    d = df.groupBy(*groups).agg(F.min(c).alias("low"), q.alias("_q"), F.max(c).alias("high"), F.count(c).alias("n"))
    return d.select(*groups, "low", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "high", "n")


_STEP = {"day": "1 DAY", "week": "7 DAYS", "month": "1 MONTH", "quarter": "3 MONTHS", "year": "1 YEAR"}


def resample(df: DataFrame, day: str, c: str, period: str) -> DataFrame:
    """(period, total): periods without rows are 0. A week is labelled by its closing Sunday."""
    start = F.date_trunc(period, day).cast("date")
    sums = df.groupBy(start.alias("_p")).agg(total(c).alias("_t"))
    spine = sums.agg(F.min("_p").alias("a"), F.max("_p").alias("b")).select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {_STEP[period]}"))).alias("_p"))
    label = F.date_add("_p", 6) if period == "week" else F.col("_p")
    return spine.join(sums, "_p", "left").select(label.alias("period"), F.coalesce("_t", F.lit(0.0)).alias("total"))


def by_period(df: DataFrame, day: str, period: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(F.date_trunc(period, day).cast("date").alias("period")).agg(*[F.try_divide(total(c), F.count(c)).alias(c) for c in columns])


def category_counts(df: DataFrame, day: str, period: str, category: str, n: int = 5) -> DataFrame:
    """Rows by period of the n most frequent categories."""
    top = df.groupBy(category).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), category).limit(n)
    kept = df.join(F.broadcast(top.select(category)), category, "left_semi")  # n rows
    return kept.groupBy(F.date_trunc(period, day).cast("date").alias("period"), category).agg(F.count("*").alias("n"))


def seasonality(df: DataFrame, day: str, c: str, by: str) -> DataFrame:
    """Mean by month (1-12) or weekday (Monday 0), or the sum by year and quarter."""
    if by == "quarter":
        return df.groupBy(F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(total(c).alias("total"))
    key = F.month(day) if by == "month" else F.weekday(day)
    return df.groupBy(key.alias(by)).agg(F.try_divide(total(c), F.count(c)).alias("mean"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, correlation) of each pair, from one pass."""
    pairs = list(itertools.combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def summary(df: DataFrame, day: str, distinct: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), *[F.countDistinct(c).alias(f"distinct_{c}") for c in distinct], *[total(c).alias(f"total_{c}") for c in sums])


def target_panels(df: DataFrame, day: str, target: str, groups: Sequence[str], n: int = 5) -> DataFrame:
    """(panel, period, key, total): the target by week, and by month for the n greatest values of each group column."""
    week = df.groupBy(F.date_trunc("week", day).cast("date").alias("period")).agg(total(target).alias("total"))
    out = week.select(F.lit("week").alias("panel"), "period", F.lit(None).cast("string").alias("key"), "total")
    for c in groups:
        top = df.groupBy(c).agg(total(target).alias("_t")).orderBy(F.desc("_t"), c).limit(n).select(c)  # n rows
        month = df.join(F.broadcast(top), c, "left_semi").groupBy(F.date_trunc("month", day).cast("date").alias("period"), c).agg(total(target).alias("total"))
        out = out.unionByName(month.select(F.lit(c).alias("panel"), "period", F.col(c).cast("string").alias("key"), "total"))
    return out
