"""Joins, set operations and small relational helpers with their NULL rules spelled out."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Distinct fact keys without a row in the dimension; null keys refer to nothing and are no orphans."""
    keys = facts.select(F.col(fact_key).alias("key")).where("key is not null").distinct()
    return keys.join(dimension.select(F.col(dimension_key).alias("key")), "key", "left_anti")


def reconciled(detail: DataFrame, summary: DataFrame, keys: Sequence[str], detail_value: str, summary_value: str, tolerance: float) -> DataFrame:
    """Groups whose detail sum and summary value differ by more than the tolerance (null keys are skipped, as equality does)."""
    sums = detail.groupBy(*keys).agg(F.sum(F.col(detail_value).cast("decimal(18,4)")).cast("double").alias("detail"))
    both = sums.join(summary.select(*keys, F.col(summary_value).alias("summary")), list(keys))
    return both.where(F.abs(F.col("detail") - F.col("summary")) > tolerance)


def row_counts(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, count_a, count_b, difference) of a full outer join of counts; a group that one side lacks counts null."""
    one = lambda df, n: (df.groupBy(*keys) if keys else df.groupBy()).agg(F.count("*").alias(n)).withColumn("_one", F.lit(1))
    both = one(a, "count_a").join(one(b, "count_b"), [*keys, "_one"], "full").drop("_one")
    return both.withColumn("difference", F.abs(F.coalesce("count_a", F.lit(0)) - F.coalesce("count_b", F.lit(0))))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that only one side has, with ``which_diff`` telling which."""
    left, right = a.subtract(b), b.select(*a.columns).subtract(a)
    return left.withColumn("which_diff", F.lit("a_minus_b")).unionByName(right.withColumn("which_diff", F.lit("b_minus_a")))


def cardinality_differences(a: DataFrame, column_a: str, b: DataFrame, column_b: str) -> DataFrame:
    count = lambda df, c: df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    return differences(count(a, column_a), count(b, column_b))


def union_relations(relations: Mapping[str, DataFrame], *, source: str | None = "_source", include: Sequence[str] | None = None, exclude: Sequence[str] = (), types: Mapping[str, str] | None = None, where: str | None = None) -> DataFrame:
    """All relations under the union of their columns; what one lacks is null. Each row names its relation."""
    out: DataFrame | None = None
    for name, df in relations.items():
        keep = [c for c in df.columns if (include is None or c in include) and c not in exclude]
        one = df.select(*[F.col(c).cast((types or {})[c]).alias(c) if c in (types or {}) else F.col(c) for c in keep])
        one = one.withColumn(source, F.lit(name)) if source else one
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no relation")
    return out.where(where) if where else out


def key_audit(full: DataFrame, incremental: DataFrame, key: str) -> DataFrame:
    """One row: rows and unique keys of both loads, new, updated and all keys, duplicates that a merge removes."""
    sides = full.select(F.col(key).alias("k"), F.lit(1).alias("f"), F.lit(0).alias("i")).unionByName(incremental.select(F.col(key).alias("k"), F.lit(0).alias("f"), F.lit(1).alias("i"))).where("k is not null")
    by_key = sides.groupBy("k").agg(F.sum("f").alias("f"), F.sum("i").alias("i"))
    n = lambda c: F.count_if(c)
    return by_key.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("full_rows"), n(F.col("f") > 0).alias("full_unique"), F.coalesce(F.sum("i"), F.lit(0)).alias("incremental_rows"), n(F.col("i") > 0).alias("incremental_unique"),
        n((F.col("f") == 0) & (F.col("i") > 0)).alias("new_keys"), n((F.col("f") > 0) & (F.col("i") > 0)).alias("updated_keys"), F.count("*").alias("total_unique"),
        F.coalesce(F.sum(F.col("f") + F.col("i")) - F.count("*"), F.lit(0)).alias("duplicates_removed"),
    )


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL's NOT IN: no row at all if the other side has a null; null values of df never pass (unless it is empty)."""
    facts = other.agg(F.count("*").alias("_n"), F.count_if(F.col(other_column).isNull()).alias("_nulls"))
    rest = df.join(other.select(F.col(other_column).alias("_o")).distinct(), F.col(column) == F.col("_o"), "left_anti")
    return rest.crossJoin(F.broadcast(facts)).where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())).drop("_n", "_nulls")  # one row


def pivoted(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, value: Column, empty=0) -> DataFrame:
    """One column per value: the sum of ``value``; the values are given, so no pass finds them."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(column) == v, value).otherwise(F.lit(empty))).alias(str(v)) for v in values])


def unpivoted(df: DataFrame, keep: Sequence[str], columns: Sequence[str], names: tuple[str, str] = ("field_name", "value"), to: str = "string") -> DataFrame:
    return df.select(*keep, *[F.col(c).cast(to).alias(c) for c in columns]).unpivot(list(keep), list(columns), *names)


def column_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Differences of two (column_name, data_type) lists, names compared without case."""
    a = before.select(F.lower("column_name").alias("name"), F.col("data_type").alias("old_type"))
    b = after.select(F.lower("column_name").alias("name"), F.col("data_type").alias("new_type"))
    both = a.join(b, "name", "full")
    change = F.when(F.col("old_type").isNull(), "column_added").when(F.col("new_type").isNull(), "column_removed").when(F.col("old_type") != F.col("new_type"), "type_changed")
    return both.select("name", change.alias("change"), "old_type", "new_type").where("change is not null")


def top_groups(df: DataFrame, group: Sequence[str], value: str, n: int) -> DataFrame:
    """The n groups of the largest exact sums; ties by the group's own order."""
    sums = df.groupBy(*group).agg(F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total"))
    return sums.orderBy(F.desc("total"), *group).limit(n)


def rows_of_top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose category is among the n most frequent."""
    top = df.groupBy(column).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), column).limit(n)
    return df.join(F.broadcast(top.select(column)), column, "left_semi")  # n rows


def first_or(df: DataFrame, default) -> DataFrame:
    """One row with the first cell of df's first column, or the default where there is none."""
    (c, *_) = df.columns
    return df.select(c).limit(1).agg(F.coalesce(F.first(c), F.lit(default)).alias(c))


def as_dict(df: DataFrame, most: int = 10_000) -> dict[str, list]:
    """A small result's columns as lists; more than ``most`` rows are refused, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return {c: [r[i] for r in rows] for i, c in enumerate(df.columns)}


def relations(spark: SparkSession, pattern: str, exclude: Sequence[str] = (), database: str | None = None) -> DataFrame:
    """(name) of tables and views like the SQL pattern, whatever the case, and like none of the excluded ones."""
    found = [(t.name,) for t in spark.catalog.listTables(database)]
    out = spark.createDataFrame(found, "name string").where(F.col("name").ilike(pattern))
    for p in exclude:
        out = out.where(~F.col("name").ilike(p))
    return out


def insert_rows(spark: SparkSession, path: str, rows: Iterable[tuple], schema: str, chunk: int = 5000) -> int:
    """Appends rows of the driver to a Parquet table, ``chunk`` at a time; how many there were."""
    total, rows = 0, iter(rows)
    while part := list(itertools.islice(rows, chunk)):
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        total += len(part)
    return total
