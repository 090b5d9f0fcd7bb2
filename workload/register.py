"""Registry that keeps a query next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .records import Tables

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``plan(tables) -> DataFrame`` under ``name`` with the SQL that gives the same rows."""

    def register(plan: Callable[[Tables], DataFrame]):
        QUERIES[name] = (lambda spark, folder: plan(Tables(spark, folder)), sql)
        return plan

    return register
