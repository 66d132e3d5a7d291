"""All queries by name, each with its DuckDB twin where SQL can express it.

A query is a function of (spark, sf_dir). Modules of this package register theirs with the decorator below.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("basics", "profiles", "preparation", "arrays", "texts", "files", "models", "learners", "streams")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Plans over literal rows: they show an operation, and tests hold them against their twins.
_EXAMPLES: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        key = name or function.__name__
        if key in _QUERIES:
            raise ValueError(f"two queries named {key}")
        _QUERIES[key] = function
        if sql is not None:
            _SQL[key] = sql
        return function

    return add


def example(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a plan that reads no table, so that it is no query."""

    def add(function: Query) -> Query:
        _EXAMPLES[function.__name__] = (function, sql)
        return function

    return add


def _loaded() -> None:
    for module in MODULES:
        import_module(f"{__package__}.{module}")


def queries() -> dict[str, Query]:
    _loaded()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _loaded()
    return dict(_SQL)


def examples() -> dict[str, tuple[Query, str | None]]:
    _loaded()
    return dict(_EXAMPLES)
