"""Named queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name, with its SQL if there is one."""

    def register(f):
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register
