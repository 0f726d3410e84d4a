"""Paged REST entities as a Spark data source: a partition is a range of pages, read in parallel and retried alone."""

from __future__ import annotations

import datetime
import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice.sources.bronze import write_arrays

Fetch = Callable[[str], dict]


def page_url(base: str, entity: str, top: int, skip: int, where: str | None = None, columns: str | None = None) -> str:
    query = {"$top": top, "$skip": skip} | ({"$filter": where} if where else {}) | ({"$select": columns} if columns else {})
    return f"{base.rstrip('/')}/{entity}?{urllib.parse.urlencode(query, safe='$,')}"


def http(url: str) -> dict:
    with urllib.request.urlopen(url, timeout=60) as r:  # noqa: S310  certificates are verified
        return json.load(r)


def pages(fetch: Fetch, base: str, entity: str, *, top: int = 1000, skip: int = 0, until: int | None = None, where: str | None = None, columns: str | None = None) -> Iterator[tuple[int, list[dict]]]:
    """(next skip, records) of each page; a short page is the last."""
    while until is None or skip < until:
        rows = fetch(page_url(base, entity, top, skip, where, columns)).get("value", [])
        skip += len(rows)
        yield skip, rows
        if len(rows) < top:
            return


def resumable(fetch: Fetch, base: str, entity: str, clock: Callable[[], float], budget: float = 300.0, **options) -> tuple[list[dict], int | None]:
    """Records within a time budget, and where to resume (None at the end)."""
    begun, out, at = clock(), [], options.get("skip", 0)
    top = options.get("top", 1000)
    for at, rows in pages(fetch, base, entity, **options):
        out += rows
        if len(rows) < top:
            return out, None
        if clock() - begun > budget:
            return out, at
    return out, at


def changed_since(entity: str, today: datetime.date, *, whole: frozenset[str] = frozenset({"ItemGroups", "SalesPersons"}), by_document: frozenset[str] = frozenset({"InventoryGenEntries"})) -> str | None:
    """The incremental filter: one day of overlap, which the upsert makes harmless; small dimensions are read whole."""
    if entity in whole:
        return None
    column = "DocDate" if entity in by_document else "UpdateDate"
    return f"{column} ge '{today - datetime.timedelta(days=1)}'"


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, options

    def partitions(self):
        size, rows = int(self.options.get("rowsPerPartition", 100_000)), int(self.options["rows"])
        return [_Range(a, min(a + size, rows)) for a in range(0, rows, size)]

    def read(self, partition):
        fetch = http
        if "fetcher" in self.options:  # module:function, for other transports and tests
            import importlib

            module, _, name = self.options["fetcher"].partition(":")
            fetch = getattr(importlib.import_module(module), name)
        names = self.schema.names
        left = partition.last - partition.first
        for _, rows in pages(fetch, self.options["url"], self.options["entity"], top=int(self.options.get("top", 1000)), skip=partition.first, until=partition.last, where=self.options.get("filter"), columns=self.options.get("select")):
            for r in rows[:left]:
                yield tuple(r.get(n) for n in names)
            left -= len(rows)


class RestSource(DataSource):
    """spark.dataSource.register(RestSource); spark.read.format("rest").schema(...).options(url, entity, rows, ...)."""

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self):
        raise ValueError("give the schema: nothing is inferred")

    def reader(self, schema):
        return _Reader(schema, dict(self.options))


def extract(spark: SparkSession, url: str, entity: str, schema: str, rows: int, root: str, today: datetime.date, *, load: str = "full", since: datetime.date | None = None, **options: str) -> str:
    """Loads an entity into Bronze: whole (documents from ``since`` on) or what changed; the path of the day's files."""
    where = changed_since(entity, today) if load == "incremental" else f"DocDate ge '{since}'" if since else None
    spark.dataSource.register(RestSource)
    told = {"url": url, "entity": entity, "rows": str(rows)} | ({"filter": where} if where else {}) | options
    path = f"{root.rstrip('/')}/{load}/year={today:%Y}/month={today:%m}/day={today:%d}"
    write_arrays(spark.read.format("rest").schema(schema).options(**told).load(), path)
    return path
