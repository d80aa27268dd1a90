"""Collects the registered queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(c: Column | str, digits: int = 9) -> Column:
    """Doubles compared across engines: fixed digits, and no negative zero."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits) + F.lit(0.0)


def r(expr: str, digits: int = 9) -> str:
    """SQL twin of ``rounded``."""
    return f"(round({expr}, {digits}) + 0.0::double)"
