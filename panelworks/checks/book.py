"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelworks.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that has to give the same rows."""

    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return query(tune(spark), sf)

        run.__name__, run.__doc__ = name, query.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def frame_mean(col: str, first: int, last: int, need: int, over: str, fn: str = "avg") -> str:
    """SQL for a gated frame: null until ``need`` non-null values are in it."""

    def bound(n: int) -> str:
        return "CURRENT ROW" if n == 0 else f"{-n} PRECEDING"

    frame = f"OVER ({over} ROWS BETWEEN {bound(first)} AND {bound(last)})"
    return f"CASE WHEN count({col}) {frame} >= {need} THEN {fn}({col}) {frame} END"


def r8(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 8) AS {name}"
