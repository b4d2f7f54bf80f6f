"""Row-local building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LOCAL_ROWS = 1_000


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns that later steps may use often without computing them again.

    A plain projection is substituted into every later filter and projection, which would repeat
    long regular-expression chains. Rows made by a one-element generator are not: filters stay
    above it, unused fields are still pruned, and it runs inside whole-stage code generation.
    """
    fields = [expression.alias(name) for name, expression in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """A 128-bit key of several columns; null differs from any value and equals null.

    Timestamps count to the microsecond, and -0.0 equals 0.0; nested values are taken as JSON.
    """
    exact = []
    for c in columns:
        kind, value = df.schema[c].dataType, F.col(c)
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, (T.TimestampNTZType, T.BinaryType)):
            value = value.cast("string") if isinstance(kind, T.TimestampNTZType) else F.hex(value)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)
        exact.append(value.alias(c))
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return F.md5(F.to_json(F.struct(*exact), options))


def without_nan(df: DataFrame, column: str) -> Column:
    """The column with NaN taken as null; only floating columns can hold one."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(column), F.lit(None).cast(kind))
    return F.col(column)


def with_row(df: DataFrame, name: str, row: DataFrame) -> DataFrame:
    """Append the only row of a table as a struct, computed once as a scalar subquery."""
    return df.withColumn(name, row.select(F.struct(*row.columns)).scalar())


def small_side(df: DataFrame) -> DataFrame:
    """The side of a join that should have a row per group: computed once and broadcast when it
    has at most a thousand rows, else left to an ordinary join."""
    rows = df.take(MAX_LOCAL_ROWS + 1)
    if len(rows) > MAX_LOCAL_ROWS:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
