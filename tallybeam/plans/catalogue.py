"""The queries by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybeam.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            body = sql.strip()
            SQL[f.__name__] = (f"WITH RECURSIVE {V.SQL}, {body[5:]}" if body.startswith("WITH ") else f"WITH RECURSIVE {V.SQL} {body}") if views else body
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
