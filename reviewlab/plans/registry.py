"""Registry of named queries: a Spark builder and, where SQL can express the
result, an equivalent DuckDB SQL text over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c, digits: int = DIGITS) -> Column:
    """Round a double for cross-engine comparison."""
    # "+ 0.0" turns a rounded -0.0 into 0.0 so both engines print the same value
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits) + F.lit(0.0)


def r_sql(expr: str, digits: int = DIGITS) -> str:
    return f"(ROUND(CAST({expr} AS DOUBLE), {digits}) + 0.0)"
