"""How far the test split differs from the train split. Input: one table with a ``split`` column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.functions.text import value_or_unknown
from jobmine.operators.ordered import quantiles, running_totals
from jobmine.operators.profiling import _long, ranked_values
from jobmine.operators.rows import with_row

KS_TERMS = 20


def ks_pvalue(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value. The alternating series converges fast for large distances
    only; below one, the same function is taken from its dual series."""
    square = statistic * statistic * (n * m / (n + m))
    terms = F.sequence(F.lit(1), F.lit(KS_TERMS))
    far = 2.0 * F.aggregate(
        terms, F.lit(0.0),
        lambda total, j: total + F.when(j % 2 == 1, 1.0).otherwise(F.lit(-1.0)) * F.exp(-2.0 * square * j * j),
    )
    odd = F.aggregate(
        terms, F.lit(0.0),
        lambda total, j: total + F.exp(-(2 * j - 1) * (2 * j - 1) * (math.pi**2 / 8) / square),
    )
    near = 1.0 - math.sqrt(2 * math.pi) / F.sqrt(square) * odd
    value = F.when(square < 1, near).otherwise(far)
    return F.when(statistic == 0, 1.0).otherwise(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def ks_shift(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance, p-value, means and medians of numeric columns.

    Rows are reduced to counts per value and split; the distributions are compared at the values.
    """
    in_train = F.col("split") == "train"
    cells = _long(df, columns, lambda c: c.cast("double"), "split").where("value IS NOT NULL")
    steps = running_totals(
        cells, "value",
        {"train": F.count(F.when(in_train, 1)), "test": F.count(F.when(~in_train, 1))},
        by=["column"],
    )
    gap = F.abs(
        (F.col("train_before") + F.col("train")) / F.col("train_all")
        - (F.col("test_before") + F.col("test")) / F.col("test_all")
    )
    distance = steps.groupBy("column").agg(
        F.max(gap).alias("ks_statistic"), F.max("train_all").alias("n"), F.max("test_all").alias("m")
    )
    means = cells.groupBy("column").agg(
        F.avg(F.when(in_train, F.col("value"))).alias("train_mean"),
        F.avg(F.when(~in_train, F.col("value"))).alias("test_mean"),
    )
    middle = quantiles(cells, "value", (0.5,), by=["column", "split"]).groupBy("column").agg(
        F.max(F.when(in_train, F.col("q")[0])).alias("train_median"),
        F.max(F.when(~in_train, F.col("q")[0])).alias("test_median"),
    )
    return means.join(middle, "column").join(distance, "column").select(
        "column", "train_mean", "test_mean", "train_median", "test_median", "ks_statistic",
        ks_pvalue(F.col("ks_statistic"), F.col("n").cast("double"), F.col("m").cast("double"))
        .alias("ks_pvalue"),
    )


def category_shift(df: DataFrame, columns: Sequence[str], n: int = 12) -> DataFrame:
    """Share of the n commonest train values in each split, and the difference."""
    in_train = F.col("split") == "train"
    cells = _long(df, columns, value_or_unknown, "split")
    counts = cells.groupBy("column", "value").agg(
        F.count(F.when(in_train, 1)).alias("train"), F.count(F.when(~in_train, 1)).alias("test")
    )
    sizes = df.agg(
        F.count(F.when(in_train, 1)).alias("train"), F.count(F.when(~in_train, 1)).alias("test")
    )
    top = ranked_values(df.where(in_train), columns, n).select("column", "value")
    found = with_row(counts.join(F.broadcast(top), ["column", "value"]), "_sizes", sizes)
    ratios = found.select("column", "value", *[
        F.coalesce(F.col(s) / F.col(f"_sizes.{s}"), F.lit(0.0)).alias(f"{s}_ratio") for s in ("train", "test")
    ])
    return ratios.withColumn("abs_diff", F.abs(F.col("train_ratio") - F.col("test_ratio")))


def clip_at_train_quantile(
    df: DataFrame, columns: Sequence[str], share: float = 0.99, split: str = "split"
) -> DataFrame:
    """Cap each column, in both splits, at its quantile in train. Narrow apart from the quantiles."""
    train = df.where(F.col(split) == "train")
    cells = _long(train, columns, lambda c: c.cast("double"))
    tops = quantiles(cells, "value", (share,), by=["column"])
    limits = tops.groupBy().agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns]
    )
    return with_row(df, "_limits", limits).withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.col(f"_limits.{c}")))
        for c in columns
    }).drop("_limits")


def shift_verdict(
    numeric: DataFrame, categorical: DataFrame,
    alpha: float = 0.05, max_statistic: float = 0.02, max_diff: float = 0.01,
) -> DataFrame:
    """Whether each column shifted. A numeric column did not when p exceeds ``alpha`` or the
    distance is small; a categorical one when its largest share difference is small."""
    steady = (F.col("ks_pvalue") > alpha) | (F.col("ks_statistic") <= max_statistic)
    largest = categorical.groupBy("column").agg(F.max("abs_diff").alias("measure"))
    return numeric.select(
        "column", F.lit("numeric").alias("kind"), F.col("ks_statistic").alias("measure"),
        (~steady).alias("shifted"),
    ).unionByName(largest.select(
        "column", F.lit("categorical").alias("kind"), "measure",
        (F.col("measure") > max_diff).alias("shifted"),
    ))


def lump_rare(df: DataFrame, col: str, n: int = 8, out: str | None = None) -> DataFrame:
    """Keep the n commonest values; null counts as ``unknown``, the rest becomes ``other``."""
    top = ranked_values(df, [col], n).agg(F.collect_set("value")).scalar()
    value = value_or_unknown(F.col(col))
    return df.withColumn(out or col, F.when(F.array_contains(top, value), value).otherwise("other"))
