"""Measures that give the same result whatever the order of summation, and ranks without a global window."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def exact(c: str | Column) -> Column:
    """A double as a decimal, so that sums do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def rounded(x: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value that a double stands for, so that 2.675 gives 2.68."""
    return F.round(x.cast("decimal(24,6)"), digits).cast("double")


def total(c: str | Column, where: Column | None = None) -> Column:
    """Exact sum of values of four decimals as a double; null if no row counts.

    Units and ten-thousandths are summed as longs and put together once per group: the sum is that of the decimals,
    but stays in fixed-width buffers of generated code, which halves the time of aggregates that also count distinctly.
    """
    x = F.col(c) if isinstance(c, str) else c
    x = x if where is None else F.when(where, x)
    units = F.floor(x)
    parts = F.floor((x - units) * 10_000 + (0.5 + 1e-6))  # a half goes up, also where a double is just below it
    return (F.sum(units).cast("decimal(20,0)") + F.sum(parts).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast("double")


def mean(c: str | Column, digits: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return rounded(total(c) / F.nullif(F.count(c), F.lit(0)), digits)


def share(part: Column, whole: Column, digits: int = 2, scale: int = 100, empty: float | None = 0.0) -> Column:
    """part / whole * scale, rounded; ``empty`` where whole is not positive."""
    ratio = rounded(F.try_divide(part, whole) * scale, digits)
    return ratio if empty is None else F.when(whole > 0, ratio).otherwise(F.lit(empty))


RANGES = 1024


def percent_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """df with the exact percent_rank() over value descending, nulls last.

    A global window would put all rows into one task. Here rows are first counted by value, and values fall into at
    most RANGES + 1 ranges by their logarithmic distance from the greatest one (a function of the value alone). The
    running count is taken within each range and the sizes of the ranges before it are added; they are few rows by
    construction, so they are broadcast. The counts are joined back on the value, null-safely.
    """
    stats = df.agg(F.min(value).alias("_low"), F.max(value).alias("_high"), (F.count("*") - 1).alias("_others"))
    span = F.log1p((F.col("_high") - F.col("_low")).cast("double"))
    place = F.floor(F.try_divide(F.log1p((F.col("_high") - F.col(value)).cast("double")), span) * (RANGES - 1))
    ranged = df.groupBy(value).agg(F.count("*").alias("_n")).crossJoin(F.broadcast(stats))  # one row
    ranged = ranged.withColumn("_range", F.when(F.col(value).isNull(), RANGES).otherwise(F.coalesce(place, F.lit(0))))
    before = W.partitionBy("_range").orderBy(F.desc_nulls_last(value)).rowsBetween(W.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.sum("_n").alias("_size"))
    earlier = F.coalesce(F.sum("_size").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(sizes.select("_range", earlier.alias("_offset"))), "_range")
    rank = F.when(F.col("_others") > 0, (F.col("_before") + F.col("_offset")) / F.col("_others")).otherwise(F.lit(0.0))
    ranked = placed.select(F.col(value).alias("_value"), rank.cast("double").alias(out))
    return df.join(ranked, df[value].eqNullSafe(ranked["_value"]), "left").drop("_value")


def abc(rank: Column) -> Column:
    return F.when(rank <= 0.2, "A").when(rank <= 0.5, "B").otherwise("C")
