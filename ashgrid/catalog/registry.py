"""Query registry: name -> Spark callable (spark, sf_dir) and DuckDB oracle SQL.

Names follow the operator inventory (lower case, spaces and '/' as '_').
An operator without SQL is checked by rows and by the pytest suite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn

    return deco
