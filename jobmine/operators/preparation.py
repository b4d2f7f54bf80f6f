"""Validity, outliers, duplicates, stratified split and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.config import NEAR_DUPLICATE_KEY
from jobmine.operators.ordered import (
    attach_by_key, largest_remainder, mark_drawn, quantiles, sample_n,
)
from jobmine.operators.rows import compute_once, row_digest, with_row
from jobmine.operators.suspects import bloom_filter, may_hold
from jobmine.session import stage

EXPECTED = "salary_expected_million_vnd"
OUTLIER_COLUMNS = ("q1", "q3", "p1", "p99", "iqr", "lower_iqr", "upper_iqr")

__all__ = [
    "dedup", "flag_outliers", "flag_outliers_iqr", "keep_valid", "mark_duplicates", "mark_valid", "near_duplicates",
    "near_duplicate_audit", "outlier_bounds", "outlier_summary", "sample_n", "scoring_flags",
    "stratified_split", "stratify_bins", "union_splits",
]


def is_valid(finite: bool = True) -> Column:
    value = F.col(EXPECTED)
    known = ~F.isnan(value) & (F.abs(value) < float("inf")) if finite else value.isNotNull()
    test = (
        (F.col("salary_parse_status") == "valid")
        & known
        & (value > 0)
        & (F.col("salary_min") <= F.col("salary_max"))
    )
    return F.coalesce(test, F.lit(False))


def mark_valid(df: DataFrame) -> DataFrame:
    return df.withColumn("target_is_valid", is_valid())


def keep_valid(df: DataFrame, finite: bool = True) -> DataFrame:
    return df.where(is_valid(finite))


def outlier_bounds(df: DataFrame, col: str = EXPECTED, status: str | None = "salary_parse_status") -> DataFrame:
    """One row: quartiles, first and last percentile and the two fences of the valid rows."""
    valid = df.where(F.col(status) == "valid") if status else df
    q = F.col("q")
    iqr = q[1] - q[0]
    return quantiles(valid, col, (0.25, 0.75, 0.01, 0.99)).select(
        "n", q[0].alias("q1"), q[1].alias("q3"), q[2].alias("p1"), q[3].alias("p99"),
        iqr.alias("iqr"), (q[0] - 1.5 * iqr).alias("lower_iqr"), (q[1] + 1.5 * iqr).alias("upper_iqr"),
    )


def flag_outliers(df: DataFrame, bounds: DataFrame, col: str = EXPECTED) -> DataFrame:
    """Append the flag and its reasons, given the one-row table of ``outlier_bounds``."""
    value, b = F.col(col), F.col("_bounds")
    fence = F.when(value < F.greatest(F.lit(0.0), b["lower_iqr"]), "below_iqr_lower").when(
        value > b["upper_iqr"], "above_iqr_upper"
    )
    tail = F.when(value < b["p1"], "below_p1").when(value > b["p99"], "above_p99")
    return (
        with_row(df, "_bounds", bounds.select(*OUTLIER_COLUMNS))
        .withColumn("outlier_reason", F.concat_ws("|", fence, tail))
        .withColumn("is_salary_outlier", F.col("outlier_reason") != "")
        .drop("_bounds")
    )


def outlier_summary(flagged: DataFrame, bounds: DataFrame) -> DataFrame:
    count = flagged.agg(F.sum(F.col("is_salary_outlier").cast("long")).cast("double")).scalar()
    return bounds.select(*OUTLIER_COLUMNS, F.coalesce(count, F.lit(0.0)).alias("outlier_count"))


def flag_outliers_iqr(df: DataFrame, col: str = EXPECTED, min_rows: int = 5) -> DataFrame:
    """Fences only, and no flag at all in a table of fewer than ``min_rows``."""
    bounds = outlier_bounds(df, col, status=None).select("n", "lower_iqr", "upper_iqr")
    value, b = F.col(col), F.col("_bounds")
    outside = (value < F.greatest(F.lit(0.0), b["lower_iqr"])) | (value > b["upper_iqr"])
    return with_row(df, "_bounds", bounds).withColumn(
        "is_salary_outlier", F.coalesce((b["n"] >= min_rows) & outside, F.lit(False))
    ).drop("_bounds")


def scoring_flags(df: DataFrame) -> DataFrame:
    """New rows are scored without an outlier test."""
    return df.withColumn("is_salary_outlier", F.lit(False))


def _repeated(keyed: DataFrame, key: str, order: str) -> DataFrame:
    """Keys of more than one row: their number of rows and the first one; written, as it is read often."""
    return stage(keyed.groupBy(key).agg(
        F.count(F.lit(1)).alias("_size"), F.min(order).alias("_first")).where("_size > 1"), "repeated")


def _with_repeats(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Append ``_size`` and ``_first`` of the rows that share the key with others, null for a row that is
    alone. Only rows whose key a Bloom filter of repeated keys may hold are joined; the others are
    passed on by the scan. ``order`` tells the rows of one key apart."""
    keyed = compute_once(df, _key=row_digest(df, list(columns)))
    repeated = _repeated(keyed.select("_key", order), "_key", order)
    suspect = may_hold(*bloom_filter(repeated, "_key"), F.col("_key"))
    kind = df.schema[order].dataType
    alone = keyed.where(~suspect).withColumns({"_size": F.lit(None).cast("long"), "_first": F.lit(None).cast(kind)})
    joined = attach_by_key(keyed.where(suspect), repeated, "_key", "_size", order, staged=True)
    return alone.unionByName(joined).drop("_key")


def near_duplicates(
    df: DataFrame, key: Sequence[str] = NEAR_DUPLICATE_KEY, order: str = "id"
) -> DataFrame:
    """Append ``is_near_duplicate``: another row has the same key. Nothing is removed.

    ``order`` is a column that tells the rows of one key apart.
    """
    marked = _with_repeats(df, key, order)
    return marked.withColumn("is_near_duplicate", F.col("_size").isNotNull()).drop("_size", "_first")


def mark_duplicates(
    df: DataFrame, order: str, id_cols: Sequence[str] = ("id",), key: Sequence[str] = NEAR_DUPLICATE_KEY
) -> DataFrame:
    """Append ``is_near_duplicate`` and ``is_first``: no row with the same id comes before it.

    Both keys are looked up on narrow rows; whole rows are joined once, by the unique column ``order``,
    and only those whose id or key may occur twice.
    """
    names = ("_near", "_same")
    keyed = compute_once(df, _near=row_digest(df, list(key)), _same=row_digest(df, list(id_cols)))
    narrow = stage(keyed.select(order, *names), "keys")
    found = {name: _repeated(narrow, name, order) for name in names}
    either = F.lit(False)
    for name in names:
        either = either | may_hold(*bloom_filter(found[name], name), F.col(name))
    decided = narrow.where(either)
    for name in names:
        decided = attach_by_key(decided, found[name], name, "_size", order, staged=True).withColumnsRenamed(
            {"_size": f"{name}_size", "_first": f"{name}_first"})
    first = F.col("_same_first").isNull() | (F.col(order) == F.col("_same_first"))
    decided = stage(decided.select(
        F.col(order).alias("_of"), F.col("_near_size").isNotNull().alias("is_near_duplicate"), first.alias("is_first")), "decided")
    alone = keyed.where(~either).withColumns({"is_near_duplicate": F.lit(False), "is_first": F.lit(True)})
    suspects = keyed.where(either).join(decided, F.col(order) == F.col("_of")).drop("_of")
    return alone.unionByName(suspects).drop(*names)


def near_duplicate_audit(
    flagged: DataFrame, id_col: str = "id", key: Sequence[str] = NEAR_DUPLICATE_KEY
) -> DataFrame:
    return flagged.where("is_near_duplicate").select(id_col, *key)


def dedup(df: DataFrame, id_cols: Sequence[str], order: str) -> DataFrame:
    """Keep the first row of each id, by the unique column ``order``; null ids are equal.

    Only rows whose id may occur more than once are moved, so a table with few duplicates moves
    counts and few rows. Rows that are alike in every column share their id, so one pass removes them too.
    """
    marked = _with_repeats(df, id_cols, order)
    first = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
    return marked.where(first).drop("_size", "_first")


def stratify_bins(
    df: DataFrame, col: str = EXPECTED, n_bins: int = 10, out: str = "stratum"
) -> DataFrame:
    """Append the quantile bin of a value: right-closed, equal edges merged, null without a bin.

    All null when the column has fewer than two values or only one bin remains.
    """
    value = F.col(col).cast("double")
    few = df.where(value.isNotNull()).select(value.alias("v")).distinct().limit(n_bins).count()
    if few < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    bins = min(n_bins, few)
    found = quantiles(df, col, [i / bins for i in range(bins + 1)]).first()["q"]
    edges = sorted(set(found))  # at most n_bins + 1 numbers
    if len(edges) < 3:
        return df.withColumn(out, F.lit(None).cast("int"))
    below = sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))
    return df.withColumn(
        out, F.when(value.isNotNull(), F.greatest(below, F.lit(1)) - 1).cast("int")
    )


def stratified_split(
    df: DataFrame, id_col: str = "id", stratum: str = "stratum", share: float = 0.1, seed: int = 42
) -> DataFrame:
    """Append ``split``: test rows are drawn by hash, in proportion, from each stratum.

    The test part has ``ceil(rows * share)`` rows, also when ids repeat or are null; strata are a few
    bins, so their sizes and ends are the only numbers that reach the driver.
    """
    filled = df.withColumn("_stratum", F.coalesce(F.col(stratum), F.lit(-1)))
    sizes = {r["_stratum"]: r["count"] for r in filled.groupBy("_stratum").count().collect()}
    if not sizes:
        return df.withColumn("split", F.lit(None).cast("string"))
    quotas = largest_remainder(sizes, share)
    told_by = [c for c in df.columns if c != stratum]
    drawn = mark_drawn(filled, id_col, quotas, "_stratum", sizes, seed, "_drawn", told_by)
    split = F.when(F.col("_drawn"), "test").otherwise(F.lit("train"))
    return drawn.select(*df.columns, split.alias("split"))


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
