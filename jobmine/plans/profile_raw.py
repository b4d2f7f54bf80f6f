"""Profile of a raw postings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from jobmine.config import CATEGORICAL_COLUMNS, LENGTH_COLUMNS, LONG_TEXT_COLUMNS
from jobmine.operators import profiling as P
from jobmine.operators.salary import flag_normal_form, salary_patterns
from jobmine.session import stage


def profile_raw(
    df: DataFrame, id_col: str = "id", salary: str = "salary",
    lengths: Sequence[str] = LENGTH_COLUMNS, categories: Sequence[str] = CATEGORICAL_COLUMNS,
    long_texts: Sequence[str] = LONG_TEXT_COLUMNS,
) -> dict[str, DataFrame]:
    """All report tables of the raw profile, by name.

    Pay texts are normalised once and written beside their ids; four reports read that. Every
    other report scans only the columns it needs.
    """
    pay = stage(salary_patterns(df.select(id_col, salary), salary), "pay-texts")
    flags = flag_normal_form(pay).drop("salary_raw_normalized", "salary_pattern")
    mentions = stage(P.salary_mention_ratio(df, long_texts), "mentions")
    patterns = P.pattern_counts(pay)
    return {
        "raw_schema_summary": P.schema_summary(df),
        "raw_missing_summary": P.missing_summary(df),
        "raw_text_length_summary": P.text_length_summary(df, lengths),
        "raw_salary_pattern_summary": patterns,
        "raw_duplicate_summary": P.duplicate_summary(df, id_col),
        "raw_top_values": P.top_values(df, categories),
        "raw_salary_mention_summary": mentions,
        "raw_salary_leakage_summary": mentions.withColumnRenamed("salary_mention_ratio", "leakage_ratio"),
        "raw_salary_outlier_examples": P.oddest(flags, id_col),
        "raw_rule_candidates": P.rules_from(mentions, patterns),
        "salary_string_length_hist": P.histogram_table(flags, "salary_length", 40, clip=120),
    }
