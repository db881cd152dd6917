"""Named queries over the given tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name`` and the SQL text that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def load_all() -> None:
    from tickforge.catalog import (  # noqa: F401
        dashboards,
        history,
        joins,
        models,
        shapes,
        storage,
        streams,
        warehouse,
    )
