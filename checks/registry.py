"""Decorator that keeps a query beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return keep


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded as in the SQL, so that the order of additions does not show."""
    names = columns or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})
