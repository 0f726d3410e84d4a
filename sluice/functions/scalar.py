"""Scalar helpers whose NULL and edge rules are fixed here, all native."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_add(*columns) -> Column:
    """A sum in which null counts 0."""
    out = F.lit(0)
    for c in columns:
        out = out + F.coalesce(_c(c), F.lit(0))
    return out


def safe_subtract(first, *rest) -> Column:
    out = F.coalesce(_c(first), F.lit(0))
    for c in rest:
        out = out - F.coalesce(_c(c), F.lit(0))
    return out


def safe_divide(a, b) -> Column:
    """Null where b is 0 or null."""
    return F.try_divide(_c(a), _c(b))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance with an earth radius of 3961 miles."""
    r = 2 * 3961 * (1.0 if unit == "mi" else 1.60934)
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(_c(lon2) - _c(lon1)) / 2), 2)
    return F.asin(F.sqrt(h)) * r


def width_bucket(value, low: float, high: float, n: int) -> Column:
    """1..n for equal bins of [low, high), 0 below and n + 1 from high on."""
    return F.width_bucket(_c(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n))


def url_host(url) -> Column:
    """What stands before the first / or ? after the scheme, with port and user; a scheme is not needed."""
    rest = F.regexp_replace(_c(url), r"^(android-app|https?)?:?//", "")
    return F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url) -> Column:
    """What follows the host's slash, up to the ?."""
    rest = F.regexp_replace(_c(url), r"^(android-app|https?)?:?//", "")
    whole = F.split_part(rest, F.lit("?"), F.lit(1))
    at = F.locate("/", whole)
    return F.when(at > 0, F.substring(whole, at + 1, F.length(whole))).otherwise("")


def url_parameter(url, name: str) -> Column:
    """The text after the first ``name=``, up to the next &; null if there is none."""
    rest = F.split_part(_c(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(rest, F.lit("&"), F.lit(1)), F.lit(""))


def surrogate_key(*columns) -> Column:
    """MD5 of the columns' texts joined by '-', null as a token."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_c(c).cast("string"), F.lit("_null_")) for c in columns]))


def date_spine(spark: SparkSession, first: datetime.date, end: datetime.date, step: str = "1 day") -> DataFrame:
    """Dates from first, while before end."""
    days = F.explode(F.sequence(F.lit(first), F.lit(end), F.expr(f"INTERVAL {step}"))).alias("day")
    return spark.range(1).select(days).where(F.col("day") < F.lit(end))


def series(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "generated_number")


def day_of_week(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def hour_of_week(c) -> Column:
    return F.concat(F.date_format(_c(c), "EEEE"), F.lit("_"), F.hour(_c(c)).cast("string"))
