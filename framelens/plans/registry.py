"""Queries beside the statements that give their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Entries:
    """Registered queries by name, and DuckDB statements by the same names."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.statements: dict[str, str] = {}

    def add(self, statement: str | None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if statement is not None:
                self.statements[query.__name__] = statement.strip()
            return query

        return register
