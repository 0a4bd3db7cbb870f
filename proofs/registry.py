"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from proofs.roles import plain

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def proof(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that must give the same rows."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add
