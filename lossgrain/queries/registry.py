"""Registration of queries and composition of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(column: str | Column, digits: int = 6) -> Column:
    """Round for comparison between engines; adding zero removes -0.0."""
    return F.round(column, digits) + F.lit(0.0)


def rs(text: str, digits: int = 6) -> str:
    """The SQL form of :func:`r`."""
    return f"(round(CAST({text} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})
