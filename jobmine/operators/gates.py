"""Quality gates. Each returns one row per check: name, failing count, passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.config import BASE_NUMERIC, CATEGORICAL_METADATA, TEXT_LENGTHS

SCHEMA = "check string, failures long"


def _verdict(df: DataFrame) -> DataFrame:
    return df.select("check", F.col("failures").cast("long"), (F.col("failures") == 0).alias("passed"))


def _literal(spark, rows: list[tuple[str, int]]) -> DataFrame:
    return _verdict(spark.createDataFrame(rows, SCHEMA))


def _from_counts(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One aggregate for all checks, turned into one row per check."""
    found = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in counts.items()])
    return _verdict(found.unpivot([], list(counts), "check", "failures"))


def require(checks: DataFrame) -> DataFrame:
    """Raise when a check failed; returns the checks."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise AssertionError(f"failed checks: {[(r['check'], r['failures']) for r in failed]}")
    return checks


def columns_present(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = set(required) - set(df.columns)
    return _literal(df.sparkSession, [("columns_present", len(missing))])


def same_schema(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.dtypes, right.dtypes
    return _literal(left.sparkSession, [("same_schema", 0 if a == b else 1)])


def split_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids that occur in both splits, and repeated ids per split.

    One shuffle of per-id counts; a frequent id is one row per task and split.
    """
    train, test = F.col("split") == "train", F.col("split") == "test"
    per_id = df.groupBy(id_col).agg(
        F.count(F.when(train, 1)).alias("train"), F.count(F.when(test, 1)).alias("test")
    )
    return _from_counts(per_id, {
        "ids_disjoint": F.count(F.when((F.col("train") > 0) & (F.col("test") > 0), 1)),
        "unique_ids_train": F.sum(F.greatest(F.col("train") - 1, F.lit(0))),
        "unique_ids_test": F.sum(F.greatest(F.col("test") - 1, F.lit(0))),
    })


def salaries_valid(df: DataFrame) -> DataFrame:
    """On all rows: status valid, positive pay, bounds in order."""
    def failing(test: Column) -> Column:
        return F.sum(F.when(F.coalesce(test, F.lit(False)), 0).otherwise(1))

    return _from_counts(df, {
        "status_valid": failing(F.col("salary_parse_status") == "valid"),
        "salary_positive": failing(F.col("salary_expected_million_vnd") > 0),
        "bounds_ordered": failing(F.col("salary_min") <= F.col("salary_max")),
    })


def no_leakage(
    weights: DataFrame, feature_columns: Sequence[str], n_rows: int, min_terms: int = 1_000
) -> DataFrame:
    """No metadata column among the features; enough terms; more weights than rows."""
    forbidden = set(CATEGORICAL_METADATA + BASE_NUMERIC + TEXT_LENGTHS) & set(feature_columns)
    shape = weights.groupBy("term_idx").agg(F.count(F.lit(1)).alias("n"))
    counted = _from_counts(shape, {
        "enough_terms": F.when(F.count(F.lit(1)) > min_terms, 0).otherwise(1),
        "more_weights_than_rows": F.when(F.coalesce(F.sum("n"), F.lit(0)) > n_rows, 0).otherwise(1),
    })
    return _literal(weights.sparkSession, [("features_are_text", len(forbidden))]).unionByName(counted)


def features_sound(
    features: DataFrame, metadata: DataFrame, width: int, id_col: str = "id", col: str = "features"
) -> DataFrame:
    """Same ids on both sides, vectors of the given width, all components finite."""
    sides = features.select(id_col, F.lit(1).alias("side")).unionByName(
        metadata.select(id_col, F.lit(2).alias("side"))
    ).groupBy(id_col).agg(F.sum("side").alias("sides"))
    matched = _from_counts(sides, {"rows_match": F.count(F.when(F.col("sides") != 3, 1))})
    finite = F.forall(col, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    shaped = _from_counts(features, {
        "width": F.count(F.when(F.size(col) != width, 1)),
        "finite": F.count(F.when(~finite, 1)),
    })
    return matched.unionByName(shaped)


def row_count(df: DataFrame, expected: int, name: str) -> DataFrame:
    return _from_counts(df, {name: F.abs(F.count(F.lit(1)) - expected)})


def clusters_labelled(
    clustered: DataFrame, labels: DataFrame, id_col: str = "cluster_id", label: str = "cluster_label"
) -> DataFrame:
    """Every cluster id is in the label map, and no row has a blank label."""
    sizes = clustered.groupBy(id_col).count()
    unknown = _from_counts(
        sizes.join(labels.select(id_col).distinct(), id_col, "left_anti"),
        {"cluster_known": F.sum("count")},
    )
    blank = F.coalesce(F.trim(F.col(label)) == "", F.lit(True))
    return unknown.unionByName(_from_counts(clustered, {"label_present": F.count(F.when(blank, 1))}))


def enough_clusters(df: DataFrame, by: str = "cluster_id", least: int = 2) -> DataFrame:
    """A model whose rows fall in fewer than ``least`` clusters cannot be scored."""
    sizes = df.groupBy(by).count()
    return _from_counts(sizes, {"enough_clusters": F.greatest(F.lit(least) - F.count(F.lit(1)), F.lit(0))})
