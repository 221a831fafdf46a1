"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent statement over the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load_all() -> None:
    from filingframe.plans import (  # noqa: F401, PLC0415
        board_queries,
        function_queries,
        io_queries,
        ledger_queries,
        letter_queries,
        resolve_queries,
    )
