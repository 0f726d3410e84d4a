"""A module's queries, each with its SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from sluice.plans.sqltext import decimal_rounds


class Catalog:
    def __init__(self, common: str = ""):
        self.functions: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}
        self.common = common

    def query(self, sql: str | None, *, common: bool = True):
        """Registers a function (spark, sf_dir) -> DataFrame under its name. sql: its oracle, after the common CTEs."""

        def add(f: Callable) -> Callable:
            self.functions[f.__name__] = f
            if sql is not None:
                head = f"WITH {self.common} " if self.common and common else ""
                body = sql.strip()
                if head and body.upper().startswith("WITH "):
                    head, body = head.rstrip() + ", ", body[5:]
                self.sql[f.__name__] = decimal_rounds(head + body)
            return f

        return add

    def queries(self) -> dict[str, Callable]:
        return dict(self.functions)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
