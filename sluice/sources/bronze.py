"""Bronze: immutable JSON arrays at {entity}/{full|incremental}/year=/month=/day=/."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _json(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def read(spark: SparkSession, base: str, load: str, day: datetime.date | None = None, schema: T.StructType | None = None) -> DataFrame | None:
    """``full``, ``incremental`` (of one day or all) or ``all``; None if an incremental day has no data.

    In ``all`` the full load's columns lead: what only an incremental file has is left out, what it lacks is null. A
    column whose types disagree raises, so nothing goes missing silently.
    """
    if load == "full":
        return _json(spark, f"{base}/full", schema)
    if load == "incremental":
        path = f"{base}/incremental" + (f"/year={day:%Y}/month={day:%m}/day={day:%d}" if day else "")
        return _json(spark, path, schema) if exists(spark, path) else None
    if load != "all":
        raise ValueError(f"unknown load type: {load}")
    parts = [_json(spark, f"{base}/{x}", schema) for x in ("full", "incremental") if exists(spark, f"{base}/{x}")]
    if not parts:
        raise FileNotFoundError(base)
    first, *rest = parts
    for other in rest:
        lead = set(first.columns)
        first = first.unionByName(other.select(*[c for c in other.columns if c in lead]), allowMissingColumns=True)
    return first


def corrupt(df: DataFrame) -> DataFrame:
    """Records that did not parse."""
    return df.where(F.col("_corrupt_record").isNotNull()) if "_corrupt_record" in df.columns else df.limit(0)


def read_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold an array, an object or JSON lines: each is read whole and parsed as what it is; bad lines go."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    shape = T.StructType([f for f in schema if f.name != "_corrupt_record"])
    as_array = F.from_json("v", T.ArrayType(shape), {"mode": "PERMISSIVE"})
    lines = F.transform(F.filter(F.split("v", r"\r?\n"), lambda x: F.trim(x) != ""), lambda x: F.from_json(x, shape, {"mode": "PERMISSIVE"}))
    one = F.array(F.from_json("v", shape, {"mode": "PERMISSIVE"}))
    is_lines = F.size(F.filter(F.split("v", r"\r?\n"), lambda x: F.trim(x).startswith("{") & F.trim(x).endswith("}"))) > 1
    rows = text.select(F.explode(F.when(F.col("v").startswith("["), as_array).when(is_lines, lines).otherwise(one)).alias("r"))
    known = F.lit(False)
    for f in shape:
        known = known | F.col(f"r.{f.name}").isNotNull()
    return rows.where(known).select("r.*")


def catalogue(spark: SparkSession, database: str, name: str, path: str) -> None:
    """A table over the JSON files, as a crawler would register it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING json OPTIONS (path '{path}', multiLine 'true')")


def write_chunks(df: DataFrame, path: str, records: int = 1000) -> None:
    """JSON files of at most so many records each; the input stays."""
    df.write.mode("append").option("maxRecordsPerFile", records).json(path)


def audit_csv(df: DataFrame, path: str) -> None:
    """CSV with nested columns as JSON text."""
    nested = {f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))}
    df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("escape", "\"").csv(path)


def read_months(spark: SparkSession, path: str, months: Sequence[tuple[int, int]]) -> DataFrame:
    """The rows of these (year, month) partitions only, from one pruned scan."""
    df, wanted = spark.read.parquet(path), F.lit(False)
    for year in sorted({y for y, _ in months}):
        wanted = wanted | ((F.col("year") == year) & F.col("month").isin([m for y, m in months if y == year]))
    return df.where(wanted)


def last_days(df: DataFrame, day: str, as_of: datetime.date, days: int) -> DataFrame:
    """Rows from so many days before as_of on."""
    return df.where(F.col(day) >= F.lit(as_of - datetime.timedelta(days=days)))


def write_arrays(df: DataFrame, path: str, records: int = 1000) -> None:
    """JSON arrays of at most so many records, a file each, as ``read`` takes them."""
    dealt = df.select(F.floor(F.monotonically_increasing_id() / records).alias("_group"), F.struct(*df.columns).alias("_record"))
    dealt.groupBy("_group").agg(F.to_json(F.collect_list("_record")).alias("value")).select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
