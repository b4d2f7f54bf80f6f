"""Report on prepared rows before features are made: what is in them, and whether the splits agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from jobmine.config import CATEGORICAL_METADATA
from jobmine.operators import profiling as P
from jobmine.operators import shift
from jobmine.session import stage

NUMERIC = ("salary_expected_million_vnd", "log_salary_expected", "salary_range_width", "final_text_length")


def feature_report(
    df: DataFrame, numeric: Sequence[str] = NUMERIC,
    categories: Sequence[str] = CATEGORICAL_METADATA, outlier: str = "is_salary_outlier",
) -> dict[str, DataFrame]:
    """Report tables by name; ``df`` has a ``split`` column.

    The narrow columns of the reports are written once, because each report reads all rows; the
    overview, which counts the cells of every column, reads ``df`` itself.
    """
    narrow = stage(df.select("split", *dict.fromkeys([*numeric, *categories])), "report-columns")
    distances = stage(shift.ks_shift(narrow, numeric), "numeric-shift")
    shares = stage(shift.category_shift(narrow, categories), "category-shift")
    return {
        "dataset_overview": P.dataset_overview(df, outlier),
        "missing_summary": P.missing_summary(df),
        "categorical_summary": P.categorical_summary(narrow, categories),
        "numeric_describe": P.numeric_describe(narrow, numeric),
        "numeric_shift": distances,
        "category_shift": shares,
        "shift_verdict": shift.shift_verdict(distances, shares),
    }
