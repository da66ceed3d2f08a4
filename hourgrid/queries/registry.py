"""Name → Spark query and, where SQL can say the same, its DuckDB text."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ["cleaning", "demand", "series", "scores", "exploration", "changes", "forecasts", "stored"]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _queries[name] = function
        if sql is not None:
            _sql[name] = sql
        return function

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"hourgrid.queries.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
