"""Versioned tables without a table format: root/v=<n>-<id>/ directories and numbered manifests, of which the last holds.

A version is written whole before the next manifest is put in place by a rename that fails where it exists: readers see
the old or the new table, a lost executor or driver leaves neither half, and of two writers at a time one is told so. History, rollback, expiry and orphan removal work on the manifest.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ConcurrentCommit(RuntimeError):
    """Another writer was first; read the table again and repeat."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), list(partition_by)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # manifest
    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.root)):
            return []
        names = (f.getPath().getName() for f in self._fs.listStatus(self._path(self.root)))
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _manifest(self) -> dict:
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "current": None, "versions": []}
        stream = self._fs.open(self._path(f"{self.root}/manifest-{numbers[-1]:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode()) | {"number": numbers[-1]}
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        """Makes the manifest the next one. Of two writers that began at the same one, only the first can."""
        temp, at = self._path(f"{self.root}/.manifest-{uuid.uuid4().hex}"), self._path(f"{self.root}/manifest-{manifest['number'] + 1:010d}.json")
        stream = self._fs.create(temp, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm.org.apache.hadoop.fs
        context = jvm.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(temp, at, self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))  # fails where it exists
        except Py4JJavaError as e:
            self._fs.delete(temp, False)
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            raise ConcurrentCommit(f"{self.root} was changed by another writer since manifest {manifest['number']}") from e

    def exists(self) -> bool:
        return self._manifest()["current"] is not None

    def read(self, version: int | None = None) -> DataFrame:
        m = self._manifest()
        version = m["current"] if version is None else version
        row = next((v for v in m["versions"] if v["version"] == version), None)
        if row is None:
            raise ValueError(f"{self.root} has no version {version}")
        return self.spark.read.schema(T.StructType.fromJson(row["schema"])).parquet(f"{self.root}/{row['path']}")

    def history(self) -> list[dict]:
        return [{k: v[k] for k in ("version", "at", "operation")} for v in self._manifest()["versions"]]

    # writing
    def write(self, df: DataFrame, operation: str = "overwrite", at: datetime.datetime | None = None, *, based_on: dict | None = None, files: int = 1, most_rows: int = 0, sort_by: Sequence[str] = ()) -> int:
        """Writes a new version; based_on: the manifest that df was read under, so that no other writer's change is lost.

        files: tasks that a partition's rows are dealt to, by a hash. most_rows: of a file, if not 0. sort_by: the order within each file, so that
        readers skip row groups.
        """
        m = based_on or self._manifest()
        version = 1 + max((v["version"] for v in m["versions"]), default=0)
        path = f"v={version}-{uuid.uuid4().hex[:8]}"
        out = df = without_void(df)
        if self.partition_by:
            out = df.repartition(*self.partition_by)
            if files > 1:  # a given number of partitions is not put together again
                parts = files * max(1, df.select(*self.partition_by).distinct().count())
                out = df.repartition(parts, *self.partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
        if sort_by:
            out = out.sortWithinPartitions(*self.partition_by, *sort_by)
        writer = out.write.mode("error").option("compression", "zstd").option("maxRecordsPerFile", most_rows)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(f"{self.root}/{path}")
        at = at or datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        row = {"version": version, "path": path, "at": at.isoformat(), "operation": operation, "schema": df.schema.jsonValue()}
        self._commit(m | {"versions": [*m["versions"], row], "current": version})
        return version

    def upsert(self, incoming: DataFrame, keys: Sequence[str], *, replace: Sequence[str] | None = None, **options) -> int:
        """Incoming rows replace those of equal keys and others stay. replace: the keys whose old rows all go (a whole
        document instead of one line). Columns only ever get added. Null keys match nothing."""
        m = self._manifest()
        if m["current"] is None:
            return self.write(incoming, "create", based_on=m, **options)
        return self.write(upserted(self.read(m["current"]), incoming, keys, replace), "upsert", based_on=m, **options)

    def delete_insert(self, incoming: DataFrame, keys: Sequence[str], **options) -> int:
        """Rows whose key is among the incoming or null go, then the incoming come."""
        m = self._manifest()
        old = self.read(m["current"])
        kept = old.join(incoming.select(*keys).distinct(), list(keys), "left_anti").dropna(subset=list(keys))
        return self.write(kept.unionByName(incoming, allowMissingColumns=True), "delete_insert", based_on=m, **options)

    # maintenance
    def rollback(self, version: int) -> None:
        m = self._manifest()
        if version not in [v["version"] for v in m["versions"]]:
            raise ValueError(f"{self.root} has no version {version}")
        self._commit(m | {"current": version})

    def compact(self, target_bytes: int = 128 << 20) -> int:
        """Rewrites the current version in files of about the target size, in each partition too."""
        m = self._manifest()
        at = next(v["path"] for v in m["versions"] if v["version"] == m["current"])
        df, size = self.read(m["current"]), self._fs.getContentSummary(self._path(f"{self.root}/{at}")).getLength()
        if not self.partition_by:
            return self.write(df.repartition(max(1, -(-size // target_bytes))), "compact", based_on=m)
        parts = max(1, df.select(*self.partition_by).distinct().count())
        files = max(1, -(-size // (parts * target_bytes)))
        return self.write(df, "compact", based_on=m, files=files, most_rows=max(1, df.count() * target_bytes // max(1, size)))

    def expire(self, before: datetime.datetime, keep: int = 3) -> list[int]:
        """Drops versions older than ``before``, but never the last ``keep`` or the current one."""
        m = self._manifest()
        last = {v["version"] for v in m["versions"][-keep:]} | {m["current"]}
        gone = [v for v in m["versions"] if v["version"] not in last and datetime.datetime.fromisoformat(v["at"]) < before]
        self._commit(m | {"versions": [v for v in m["versions"] if v not in gone]})
        for v in gone:
            self._fs.delete(self._path(f"{self.root}/{v['path']}"), True)
        for n in self._numbers()[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifest-{n:010d}.json"), False)
        return [v["version"] for v in gone]

    def remove_orphans(self) -> list[str]:
        """Deletes version directories that the manifest does not name (failed writes)."""
        known = {v["path"] for v in self._manifest()["versions"]}
        gone = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.root)) if f.isDirectory() and f.getPath().getName().startswith("v=") and f.getPath().getName() not in known]
        for name in gone:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
        return gone


def without_void(df: DataFrame) -> DataFrame:
    """Columns without a type become strings."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f.name) for f in df.schema])


def upserted(old: DataFrame, incoming: DataFrame, keys: Sequence[str], replace: Sequence[str] | None = None) -> DataFrame:
    by = list(replace or keys)
    kept = old.join(incoming.select(*by).distinct(), by, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


# Slowly changing dimensions, type 2.
VERSION_COLUMNS = ("_valid_from", "_valid_to", "_is_current", "_row_hash")
_NULL = "\x00null"


def row_hash(df: DataFrame, but: Sequence[str] = ()) -> Column:
    """SHA-256 of the business columns in name order; a null differs from every text."""
    skip = {*but, *VERSION_COLUMNS, "_sk", "_silver_loaded_at", "_silver_load_date", "_source_file", "year", "month", "day"}
    names = sorted(c for c in df.columns if c not in skip and "odata" not in c.lower())
    return F.sha2(F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in names]), 256)


def scd2(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str], ts: datetime.datetime, but: Sequence[str] = ()) -> DataFrame:
    """The whole table after a load at ts, in one pass: history and equal rows stay, changed rows close at ts and a new
    version begins at ts, new keys begin at ts. Keys that do not come stay current. Incoming keys are unique."""
    at = F.lit(ts).cast("timestamp")
    fresh = incoming.withColumn("_row_hash", row_hash(incoming, but))
    begun = {"_valid_from": at, "_valid_to": F.lit(None).cast("timestamp"), "_is_current": F.lit(True)}
    if current is None:
        return fresh.withColumns(begun)
    live = current.where("_is_current").select(*keys, F.col("_row_hash").alias("_old"))
    known = fresh.join(live, list(keys), "left")
    added = known.where(F.col("_old").isNull() | (F.col("_old") != F.col("_row_hash"))).drop("_old").withColumns(begun)
    incoming_hash = fresh.select(*keys, F.col("_row_hash").alias("_new"))
    old = current.join(incoming_hash, list(keys), "left")
    closes = F.col("_is_current") & F.col("_new").isNotNull() & (F.col("_new") != F.col("_row_hash"))
    old = old.withColumns({"_valid_to": F.when(closes, at).otherwise(F.col("_valid_to")), "_is_current": F.col("_is_current") & ~closes}).drop("_new")
    return old.unionByName(added, allowMissingColumns=True)


def current_rows(table: DataFrame) -> DataFrame:
    return table.where("_is_current")
