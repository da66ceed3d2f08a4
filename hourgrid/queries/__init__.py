"""Registered queries over the given tables, each with its SQL counterpart."""

from hourgrid.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
