"""From raw postings to a cleaned, deduplicated, split table with its audit reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmine.config import Settings
from jobmine.operators import cleaning, preparation, profiling
from jobmine.operators.rows import row_digest
from jobmine.operators.salary import parse_salary, require_contract, salary_range_width
from jobmine.session import stage

ORDER = "_order"


@dataclass(frozen=True)
class Prepared:
    """``raw`` and ``clean`` carry a ``split`` column; ``audits`` are small reports by name."""

    raw: DataFrame
    clean: DataFrame
    audits: dict[str, DataFrame]


def prepare(df: DataFrame, settings: Settings = Settings()) -> Prepared:
    """Parse, filter, flag, deduplicate, split and clean.

    The parsed, the deduplicated and the cleaned rows are each written once, because several
    reports and steps read them; everything in between is narrow or moves keys and counts only.
    """
    contract = require_contract(df.sparkSession, settings)
    # By content, so that the row that stays does not depend on partitions; alike rows by number.
    place = F.concat(row_digest(df, df.columns), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    numbered = df.withColumn(ORDER, place)
    parsed = salary_range_width(parse_salary(numbered, "salary", settings))
    parsed = stage(preparation.mark_valid(parsed), "parsed")

    valid = parsed.where("target_is_valid")
    bounds = preparation.outlier_bounds(valid)
    flagged = preparation.flag_outliers(valid, bounds)
    marked = preparation.mark_duplicates(flagged, ORDER)
    unique = marked.where("is_first") if settings.dedup else marked
    unique = stage(unique.drop("is_first"), "unique")

    binned = preparation.stratify_bins(unique, n_bins=settings.n_bins)
    raw = preparation.stratified_split(binned, "id", "stratum", settings.test_share, settings.seed)
    raw = raw.drop("stratum", ORDER)
    filled = stage(cleaning.fill_unknowns(raw), "filled")
    clean = filled
    if settings.remove_salary_mentions:
        clean = cleaning.strip_salary_mentions(filled)
    log = cleaning.mention_log(filled, removed=settings.remove_salary_mentions)
    mentions = cleaning.mention_log_by_column(log)
    distribution = profiling.split_distribution(raw)
    audits = {
        "clean_salary_mention_summary": mentions,
        "near_duplicate_audit": preparation.near_duplicate_audit(unique),
        "salary_outlier_summary": preparation.outlier_summary(flagged, bounds),
        "salary_parse_audit": profiling.parse_audit(parsed),
        "salary_parser_tests": contract,
        "processing_summary": profiling.processing_summary(parsed, valid, raw, {
            "test_size": settings.test_share, "random_state": settings.seed,
            "remove_salary_mentions": settings.remove_salary_mentions,
        }),
        "train_test_salary_distribution": distribution,
        "train_test_target_distribution": distribution.withColumnsRenamed(
            {"salary_mean": "target_mean", "salary_median": "target_median"}
        ),
        "data_dictionary": profiling.data_dictionary(df.sparkSession),
        "salary_outlier_examples": profiling.outlier_examples(raw),
        "salary_by_split_hist": profiling.histogram_table(
            raw, "salary_expected_million_vnd", 40, by=["split"]
        ),
        "salary_boxplot": profiling.boxplot_table(raw, "salary_expected_million_vnd"),
        "outlier_flag_ratio": profiling.flag_ratio(raw),
    }
    return Prepared(raw, clean, audits)
