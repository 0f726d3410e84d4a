"""From a raw document to typed, clean, unique Silver rows. Every step is one projection or one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schemas import Entity


def to_date(c: str | Column) -> Column:
    """A date from its first ten characters (yyyy-MM-dd, with or without a time); null where malformed."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def _typed(source: Column, kind: str) -> Column:
    return to_date(source) if kind == "date" else source.try_cast(kind)


def typed(df: DataFrame, fields: list[tuple[str, str, str]], prefix: str = "") -> list[Column]:
    """Columns of the fixed projection; what a source lacks is null, what does not parse too."""
    have = set(df.schema[prefix.rstrip(".")].dataType.names if prefix else df.columns)
    return [(_typed(F.col(prefix + s), k) if s in have else F.lit(None).cast(k)).alias(out) for s, out, k in fields]


def additional_expenses(df: DataFrame, column: str = "DocumentAdditionalExpenses") -> Column:
    """The sum of a document's expense lines: missing column, array or amount counts 0."""
    if column not in df.columns:
        return F.lit(0.0)
    amounts = F.coalesce(F.col(column), F.array().cast("array<struct<LineTotal:double>>"))
    return F.aggregate(amounts, F.lit(0.0), lambda s, x: s + F.coalesce(x["LineTotal"], F.lit(0.0)))


def flatten(df: DataFrame, entity: Entity) -> DataFrame:
    """One row per document line; documents without lines vanish."""
    extra = [c for c in ("_source_file",) if c in df.columns]
    if not entity.lines:
        return df.select(*typed(df, entity.header), *extra)
    lines = df.select("*", additional_expenses(df).alias("_expenses"), F.explode("DocumentLines").alias("_line"))
    return lines.select(*typed(lines, entity.header), *typed(lines, entity.lines, "_line."), F.col("_expenses").alias("document_additional_expenses"), *extra)


def clean_strings(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Runs of line breaks become one blank and ends are trimmed, in all string columns but those named."""
    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)} - set(but)
    return df.select(*[F.trim(F.regexp_replace(c, r"[\r\n]+", " ")).alias(c) if c in strings else F.col(c) for c in df.columns])


def valid_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not null and, where numeric, not negative."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
        if isinstance(df.schema[k].dataType, T.NumericType):
            ok = ok & (F.col(k) >= 0)
    return df.where(ok)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in a total order. Partial maxima meet in the shuffle, so a hot key is no hot task."""
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in columns])


def latest_by_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The same with row_number, for orders that a struct cannot express (mixed directions)."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def surrogate_key(keys: Sequence[str]) -> Column:
    return F.sha2(F.concat_ws("||", *[F.col(k).cast("string") for k in keys]), 256)


def date_partitions(c: str) -> dict[str, Column]:
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def masked(columns: Sequence[str], where: Column | None = None) -> dict[str, Column]:
    """SHA-256 of values (null stays null) where the condition holds."""
    out = {c: F.sha2(F.col(c).cast("string"), 256) for c in columns}
    return {c: F.when(where, h).otherwise(F.col(c)) for c, h in out.items()} if where is not None else out


def mask_partners(df: DataFrame, columns: Sequence[str], tax_id: str = "federal_tax_id") -> DataFrame:
    """Hashes contact data and the tax id of those that have one. One projection, so the condition sees the plain id."""
    has = F.coalesce(F.length(F.trim(tax_id)) > 0, F.lit(False))
    return df.withColumns(masked(columns, has))


def silver(df: DataFrame, entity: Entity, loaded_at: Column | None = None) -> DataFrame:
    """The whole path: flatten, clean, check keys, keep the latest version, mask, key and stamp."""
    out = clean_strings(flatten(df, entity), but=("_source_file", "free_text"))
    out = valid_keys(out, entity.key)
    if "_source_file" in out.columns:
        payload = [c for c in out.columns if c not in entity.key and c != "_source_file"]
        out = latest(out, entity.key, ["_source_file", F.xxhash64(*payload)]).drop("_source_file")
    if entity.name == "business_partners":
        out = mask_partners(out, entity.masked)
    elif entity.masked:
        out = out.withColumns(masked(entity.masked))
    if entity.lines:
        out = out.withColumns(date_partitions("doc_date"))
    else:
        out = out.withColumn("_sk", surrogate_key(entity.key))
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    return out.withColumns({"_silver_loaded_at": at, "_silver_load_date": at.cast("date")})
