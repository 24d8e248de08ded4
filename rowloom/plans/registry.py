"""Where queries and the SQL that states their expected result are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(col: str | Column, name: str | None = None, digits: int = 6) -> Column:
    """Rounded, and free of negative zero, so that engines can be compared by value."""
    column = F.col(col) if isinstance(col, str) else col
    return (F.round(column, digits) + F.lit(0.0)).alias(name or col)


def rnd(expression: str, name: str, digits: int = 6) -> str:
    """The SQL twin of ``rounded``."""
    return f"round({expression}, {digits}) + 0.0 AS {name}"
