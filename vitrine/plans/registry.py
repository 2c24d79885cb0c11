"""Registered queries, the SQL their results are held against, and what they cover."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def register(name: str, covers: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Add a query; ``covers`` names the operators of the inventory it exercises."""
    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        COVERS[name] = tuple(covers.split())
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return add
