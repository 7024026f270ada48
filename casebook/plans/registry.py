"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from casebook.plans.roles import duck

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name; ``sql`` may hold {table} and role texts."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = duck(sql)
        return f

    return add
