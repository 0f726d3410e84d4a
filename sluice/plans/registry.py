"""All queries of the library's own operators, by inventory id."""

from __future__ import annotations

from sluice.plans import access_queries, eda_queries, function_queries, mart_queries, quality_queries, series_queries, silver_queries, store_queries

_MODULES = (mart_queries, silver_queries, function_queries, quality_queries, series_queries, eda_queries, store_queries, access_queries)


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.oracle_sql().items()}
