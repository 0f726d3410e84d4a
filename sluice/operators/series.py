"""Daily series and their features.

All windows of a series share one partitioning and one order, so Spark sorts once. Frames end at the day before:
a feature never sees the day that it helps to predict.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.operators.aggregates import total

LAGS = (1, 2, 3, 7, 14, 21, 30, 60, 90)
WINDOWS = (7, 14, 30)


def daily(lines: DataFrame, keys: Sequence[str], day: str = "doc_date", *, names: Sequence[str] = ()) -> DataFrame:
    """One row per day and series; rows with a null key vanish. price is weighted by quantity, names are the least ones."""
    d = lines.dropna(subset=[day, *keys]).groupBy(F.col(day).alias("date"), *keys).agg(
        total("quantity").alias("quantity"), total("line_total").alias("value"), total("gross_profit").alias("profit"),
        F.sum((F.col("unit_price") * F.col("quantity")).cast("decimal(24,6)")).cast("double").alias("_weighted"),
        F.try_divide(total("discount_percent"), F.count("discount_percent")).alias("discount"), F.countDistinct("card_code").alias("customers"), F.count("*").alias("sales"),
        *[F.min(n).alias(n) for n in names],
    )
    d = d.withColumn("price", F.try_divide("_weighted", "quantity")).drop("_weighted")
    return d.withColumns({"ticket": F.try_divide("value", "sales"), "margin": F.try_divide("profit", "value")})


def filled(series: DataFrame, keys: Sequence[str], *, zero: Sequence[str] = ("quantity", "value"), carry: Sequence[str] = ("price",)) -> DataFrame:
    """Every day between a series' first and last: sums are 0 on days without sales, attributes are carried forward."""
    span = series.groupBy(*keys).agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    days = span.select(*keys, F.explode(F.sequence("_a", "_b")).alias("date"))
    d = days.join(series, [*keys, "date"], "left")
    w = W.partitionBy(*keys).orderBy("date")
    past, rest = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    d = d.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(rest)) for c in carry})
    return d.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in zero})


def _by(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy("date")


def lags(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("quantity", "value"), steps: Sequence[int] = LAGS) -> DataFrame:
    w = _by(keys)
    return df.withColumns({f"{c}_lag_{n}": F.coalesce(F.lag(c, n).over(w), F.lit(0.0)) for c in columns for n in steps})


def rolling(df: DataFrame, keys: Sequence[str], c: str = "quantity", windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Statistics of the n rows before; a deviation needs two."""
    out = {}
    for n in windows:
        w = _by(keys).rowsBetween(-n, -1)
        out |= {
            f"{c}_mean_{n}": F.avg(c).over(w), f"{c}_sum_{n}": F.sum(c).over(w), f"{c}_min_{n}": F.min(c).over(w), f"{c}_max_{n}": F.max(c).over(w), f"{c}_std_{n}": F.stddev_samp(c).over(w),
            f"{c}_q95_{n}": F.percentile(c, F.lit(0.95)).over(w), f"{c}_nonzero_{n}": F.count(F.when(F.col(c) > 0, 1)).over(w).cast("double"),
        }
    return df.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in out.items()})


def _ewm(x: np.ndarray, a: float, size: int = 128) -> np.ndarray:
    """The mean of what came before each value (0 before the first), ``size`` values at a time."""
    out = np.zeros(len(x) + 1)
    if len(x):
        steps = np.arange(size)
        weights = np.tril(a * (1 - a) ** (steps[:, None] - steps[None, :]).clip(0))
        y = x[0]
        for i in range(0, len(x), size):
            own = x[i : i + size]
            n = len(own)
            out[i + 1 : i + n + 1] = weights[:n, :n] @ own + (1 - a) ** (steps[:n] + 1) * y
            y = out[i + n]
    return out[:-1]


def ewm(df: DataFrame, keys: Sequence[str], c: str = "quantity", spans: Sequence[int] = WINDOWS) -> DataFrame:
    """Exponentially weighted means y = (1 - a) y + a x with a = 2 / (span + 1), shifted by one day.

    A recursion over a series has no window form that is linear in its length, so each series (bounded by its days) is
    one Arrow group.
    """
    names = [f"{c}_ewm_{s}" for s in spans]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("date")
        xs = table.column(c).to_numpy().astype(np.float64)
        for s, name in zip(spans, names, strict=True):
            table = table.append_column(name, pa.array(_ewm(xs, 2 / (s + 1))))
        return table

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` double" for n in names])
    return df.groupBy(*keys).applyInArrow(run, schema)


def since_last_sale(df: DataFrame, keys: Sequence[str], c: str = "quantity") -> DataFrame:
    """Rows since the last day with sales (0 on such a day), 999 before the first."""
    w = _by(keys)
    rn = F.row_number().over(w)
    d = df.withColumn("_rn", rn)
    last = F.last(F.when(F.col(c) > 0, F.col("_rn")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return d.withColumn("days_since_last_sale", F.coalesce(F.col("_rn") - last, F.lit(999))).drop("_rn")


def since_peak(df: DataFrame, keys: Sequence[str], c: str = "quantity", n: int = 30) -> DataFrame:
    """Days since the first maximum of the n rows before; n without history."""
    past = F.collect_list(c).over(_by(keys).rowsBetween(-n, -1))
    d = df.withColumn("_past", past)
    return d.withColumn("days_since_peak", F.when(F.size("_past") == 0, n).otherwise(F.size("_past") - F.array_position("_past", F.array_max("_past")).cast("int") + 1)).drop("_past")


def price_features(df: DataFrame, keys: Sequence[str], c: str = "price") -> DataFrame:
    """Lags, rolling statistics, and yesterday's differences and relative changes; undefined ones are 0."""
    w = _by(keys)
    lag = lambda n: F.lag(c, n).over(w)
    out = {f"{c}_lag_{n}": lag(n) for n in (1, 7, 30)}
    for n in WINDOWS:
        f = w.rowsBetween(-n, -1)
        out |= {f"{c}_mean_{n}": F.avg(c).over(f), f"{c}_std_{n}": F.stddev_samp(c).over(f)}
    for n in (1, 7):
        out |= {f"{c}_diff_{n}": lag(1) - lag(n + 1), f"{c}_pct_{n}": F.try_divide(lag(1), lag(n + 1)) - 1}
    return df.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in out.items()})


def trends(df: DataFrame, keys: Sequence[str], c: str = "quantity") -> DataFrame:
    """Relative change of yesterday and of a week ago against the day before each, and differences of past days only."""
    w = _by(keys)
    lag = lambda n: F.lag(c, n).over(w)
    out = {f"{c}_pct_1": F.try_divide(lag(1), lag(2)) - 1, f"{c}_pct_7": F.try_divide(lag(7), lag(8)) - 1, f"{c}_diff_1": lag(1) - lag(2), f"{c}_diff_7": lag(1) - lag(8)}
    return df.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in out.items()})


def moving_average(df: DataFrame, keys: Sequence[str], c: str, n: int) -> Column:
    return F.avg(c).over(_by(keys).rowsBetween(-(n - 1), 0))


def business(df: DataFrame) -> DataFrame:
    """Ratios guarded against zero, and logarithms of counts."""
    q, v = F.col("quantity"), F.col("value")
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return df.withColumns({"value_per_unit": safe(v, q), "profit_per_unit": safe(F.col("profit"), q), "margin_rate": safe(F.col("profit"), v), "log_quantity": F.log1p(F.greatest(q, F.lit(0.0))), "strong_discount": (F.coalesce("discount", F.lit(0.0)) >= 10).cast("int")})


def newest(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each series' last known value of every column."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in columns], F.max("date").alias("date"))


def drop_outliers(df: DataFrame, key: str, c: str = "quantity", least: int = 10, sigmas: float = 3.0) -> DataFrame:
    """Items with at least so many rows, less rows above mean + sigmas deviations (a single row has no deviation)."""
    w = W.partitionBy(key)
    d = df.withColumns({"_n": F.count("*").over(w), "_m": F.avg(c).over(w), "_s": F.stddev_samp(c).over(w)})
    return d.where((F.col("_n") >= least) & (F.col(c) <= F.col("_m") + sigmas * F.col("_s"))).drop("_n", "_m", "_s")
