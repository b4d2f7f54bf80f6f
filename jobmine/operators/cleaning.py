"""Table-level text steps: cleaning, pay mentions, engineered columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmine.config import FEATURE_TEXT_COLUMNS, LONG_TEXT_COLUMNS, TEXT_COLUMNS
from jobmine.functions import text as T
from jobmine.operators.rows import compute_once


def clean_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: T.clean_text(F.col(c)) for c in columns})


def fill_unknowns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Clean the columns; blanks and their spellings become ``unknown``."""
    cleaned = compute_once(df, **{f"_clean_{c}": T.clean_text(F.col(c)) for c in columns})
    return cleaned.select(*[
        T.unknown_if_blank(F.col(f"_clean_{c}")).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])


def flag_salary_mentions(df: DataFrame, columns: Sequence[str] = LONG_TEXT_COLUMNS) -> DataFrame:
    """Append ``<column>_mentions_salary`` for raw text columns."""
    return df.withColumns(
        {f"{c}_mentions_salary": T.mentions_salary(F.col(c)) for c in columns}
    )


def strip_salary_mentions(df: DataFrame, columns: Sequence[str] = LONG_TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: T.strip_salary_mentions(F.col(c)) for c in columns})


def clean_table(
    df: DataFrame, remove_mentions: bool = False,
    columns: Sequence[str] = TEXT_COLUMNS, long_columns: Sequence[str] = LONG_TEXT_COLUMNS,
) -> DataFrame:
    """Fill unknowns and, on request, remove pay mentions from the long texts. Narrow."""
    cleaned = fill_unknowns(df, columns)
    return strip_salary_mentions(cleaned, long_columns) if remove_mentions else cleaned


def mention_log(
    filled: DataFrame, long_columns: Sequence[str] = LONG_TEXT_COLUMNS, removed: bool = False
) -> DataFrame:
    """Per split and long column: rows that mention pay, their share, whether they were removed.

    ``filled`` is the table before removal. One pass for all columns and splits.
    """
    hits = [
        F.sum(T.cleaned_mentions_salary(F.col(c)).cast("long")).alias(c) for c in long_columns
    ]
    counted = filled.groupBy("split").agg(F.count(F.lit(1)).alias("_rows"), *hits)
    return counted.unpivot(
        ["split", "_rows"], list(long_columns), "column", "rows_with_salary_mentions"
    ).select(
        "split", "column", "rows_with_salary_mentions",
        (F.col("rows_with_salary_mentions") / F.col("_rows")).alias("salary_mention_ratio"),
        F.lit(removed).alias("salary_mentions_removed"),
    )


def mention_log_by_column(log: DataFrame) -> DataFrame:
    """Both splits together: rows added, ratios averaged without weights, flag kept if set once."""
    return log.groupBy("column").agg(
        F.sum("rows_with_salary_mentions").alias("rows_with_salary_mentions"),
        F.avg("salary_mention_ratio").alias("salary_mention_ratio"),
        F.max("salary_mentions_removed").alias("salary_mentions_removed"),
    )


def simplify_location(
    df: DataFrame, col: str = "location", fold: bool = True, map_d: bool = False
) -> DataFrame:
    return df.withColumn("location_simplified", T.simplify_location(F.col(col), fold, map_d))


def final_text(df: DataFrame, columns: Sequence[str] = FEATURE_TEXT_COLUMNS) -> DataFrame:
    return df.withColumn("final_text", T.final_text([F.col(c) for c in columns]))


def text_lengths(
    df: DataFrame, columns: Sequence[str] = (*LONG_TEXT_COLUMNS, "final_text")
) -> DataFrame:
    return df.withColumns(
        {f"{c}_length": F.length(F.coalesce(F.col(c), F.lit(""))) for c in columns}
    )


def log_numeric(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{source: target}``: log1p of the value, negatives as 0, null stays null."""
    return df.withColumns({
        out: F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c), F.lit(0.0))))
        for c, out in columns.items()
    })


def bool_to_int(df: DataFrame, col: str = "is_salary_outlier") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("int"))


def engineer(df: DataFrame, fold: bool = True) -> DataFrame:
    """All engineered columns of a clean table."""
    named = final_text(simplify_location(df, fold=fold))
    measured = log_numeric(text_lengths(named), {
        "salary_expected_million_vnd": "log_salary_expected",
        "salary_range_width": "log_salary_range_width",
    })
    return bool_to_int(measured)
