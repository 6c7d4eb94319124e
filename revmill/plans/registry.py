"""Named queries, each with the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revmill.plans.views import SQL_VIEWS, Views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str, views: str) -> str:
    """Put the named view definitions before the statement, or before its own WITH list."""
    names = views.split()
    if not names:
        return sql.strip()
    defs = ",\n".join(SQL_VIEWS[v] for v in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {defs},\n{body[5:]}"
    return f"WITH {defs}\n{body}"


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of Views under a name."""

    def register(fn: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Views(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register
