"""The query book: name -> Spark builder, name -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict[str, Builder], dict[str, str]]:
    """Import every catalog module (they register on import)."""
    from calforge.plans import catalog, catalog_more, catalog_text  # noqa: F401
    return QUERIES, ORACLE
