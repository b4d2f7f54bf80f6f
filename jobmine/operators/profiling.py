"""Profiles and audit tables: one aggregate over the rows, then a small report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmine.config import AMBIGUOUS_KEYWORDS, LENGTH_COLUMNS, LONG_TEXT_COLUMNS, NEAR_DUPLICATE_KEY, Settings
from jobmine.functions import text as T
from jobmine.operators.ordered import first_n, quantiles
from jobmine.operators.rows import row_digest, small_side, with_row, without_nan
from jobmine.operators.salary import salary_length_flags, salary_patterns

# What each prepared column is for.
DATA_DICTIONARY = (
    ("salary_expected_million_vnd", "numeric_feature", "Expected salary in million VND, used as a clustering feature."),
    ("salary_min", "numeric_audit", "Lower salary bound in million VND."),
    ("salary_max", "numeric_audit", "Upper salary bound in million VND."),
    ("salary_range_width", "numeric_feature_candidate", "Difference between salary_max and salary_min."),
    ("is_salary_outlier", "audit_flag", "Salary outlier flag; not removed by default."),
    ("job_title", "text_feature", "Job title text."),
    ("job_description", "text_feature", "Job description text."),
    ("requirements", "text_feature", "Requirements text."),
    ("benefits", "text_feature", "Benefits text."),
    ("location", "categorical_feature", "Job location."),
    ("job_type", "categorical_feature", "Job type."),
    ("job_industry", "categorical_feature", "Job industry."),
    ("experience_level", "categorical_feature", "Experience level."),
    ("education_level", "categorical_feature", "Education level."),
    ("job_position", "categorical_feature", "Job position."),
)


def _long(df: DataFrame, columns: Sequence[str], expression, *keep: str) -> DataFrame:
    """One (column, value) row per cell, with one expression for every column; NaN is null."""
    cells = [
        F.struct(F.lit(c).alias("column"), expression(without_nan(df, c)).alias("value")) for c in columns
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value"
) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(columns), name, value)


def schema_summary(
    df: DataFrame, split: str | None = None, approximate: bool = False
) -> DataFrame:
    """Per column: type, nulls, null ratio and distinct values, from a single pass.

    Distinct cells are counted on 128-bit digests, so long texts are not shuffled; cells are
    combined per task first, so a value that fills a column costs one row per task.
    ``approximate`` replaces the count by a sketch without any wide shuffle.
    """
    types = dict(df.dtypes)
    keep = [split] if split else []
    columns = [c for c in df.columns if c not in keep]
    cells = _long(df, columns, lambda c: F.md5(c.cast("string")), *keep)
    if approximate:
        found = cells.groupBy(*keep, "column").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("value").alias("present"),
            F.approx_count_distinct("value").alias("n_unique"),
        )
    else:
        counted = cells.groupBy(*keep, "column", "value").agg(F.count(F.lit(1)).alias("cells"))
        found = counted.groupBy(*keep, "column").agg(
            F.sum("cells").alias("rows"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("cells")).otherwise(0)).alias("present"),
            F.count("value").alias("n_unique"),
        )
    missing = F.col("rows") - F.col("present")
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return found.select(
        *keep, "column", dtype[F.col("column")].alias("dtype"),
        missing.alias("missing_count"), (missing / F.col("rows")).alias("missing_ratio"), "n_unique",
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """Null count and ratio per column, most missing first; one aggregate without a shuffle of rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(without_nan(df, c)).alias(c) for c in df.columns],
    )
    return (
        unpivot(counts, ["_rows"], df.columns, "column", "present")
        .select(
            "column",
            (F.col("_rows") - F.col("present")).alias("missing_count"),
            ((F.col("_rows") - F.col("present")) / F.col("_rows")).alias("missing_ratio"),
        )
        .orderBy(F.desc("missing_ratio"), "column")
    )


def with_ratio(counts: DataFrame, count: str = "count") -> DataFrame:
    """Append each count's share of the total; for small tables of counts."""
    return counts.withColumn("ratio", F.col(count) / counts.agg(F.sum(count)).scalar())


def pattern_counts(patterned: DataFrame) -> DataFrame:
    """Counts and shares of the patterns of a table that has them."""
    found = patterned.groupBy("salary_pattern").count()
    return with_ratio(found).orderBy(F.desc("count"), "salary_pattern")


def salary_pattern_summary(df: DataFrame, col: str = "salary") -> DataFrame:
    return pattern_counts(salary_patterns(df.select(col), col))


def duplicate_summary(
    df: DataFrame, id_col: str = "id", near_key: Sequence[str] = NEAR_DUPLICATE_KEY
) -> DataFrame:
    """Rows that share their id, all their columns or the near key with another row.

    The three checks are keys of one table of digests: one scan, one combined shuffle.
    """
    checks = {
        "duplicate_id": [id_col],
        "duplicate_full_row": df.columns,
        "duplicate_near_key": list(near_key),
    }
    keys = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), row_digest(df, columns).alias("key"))
        for name, columns in checks.items()
    ])))
    sizes = keys.groupBy("check", "key").agg(F.count(F.lit(1)).alias("size"))
    repeated = F.when(F.col("size") > 1, F.col("size")).otherwise(0)
    return sizes.groupBy("check").agg(F.sum(repeated).alias("count"))


def text_length_summary(df: DataFrame, columns: Sequence[str] = LENGTH_COLUMNS) -> DataFrame:
    """Mean, median, 90th percentile and maximum number of characters; null counts as empty."""
    lengths = _long(df, columns, lambda c: F.length(F.coalesce(c.cast("string"), F.lit(""))))
    moments = lengths.groupBy("column").agg(
        F.avg("value").alias("mean_length"), F.max("value").alias("max_length")
    )
    shares = quantiles(lengths, "value", (0.5, 0.9), by=["column"])
    return moments.join(shares, "column").select(
        "column", "mean_length", F.col("q")[0].alias("median_length"),
        F.col("q")[1].alias("p90_length"), "max_length",
    )


def ranked_values(
    df: DataFrame, columns: Sequence[str], n: int, by: Sequence[str] = ()
) -> DataFrame:
    """The n most frequent values of each column (in each group), ties by value.

    The rank filter is applied on each shuffle partition before the final one, so a column with
    very many values does not end up in one task.
    """
    counts = (
        _long(df, columns, T.value_or_unknown, *by).groupBy(*by, "column", "value").count()
    )
    order = Window.partitionBy(*by, "column").orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    return ranked_values(df, columns, n).select("column", "value", "count")


def salary_mention_ratio(
    df: DataFrame, columns: Sequence[str] = LONG_TEXT_COLUMNS, ratio: str = "salary_mention_ratio"
) -> DataFrame:
    """Share of rows that mention pay, per text column; ``ratio`` names the result."""
    return (
        _long(df, columns, lambda c: T.mentions_salary(c).cast("int"))
        .groupBy("column").agg(F.avg("value").alias(ratio))
    )


def oddest(flagged: DataFrame, id_col: str = "id", n: int = 200) -> DataFrame:
    """Two currencies first, then the longest."""
    return flagged.orderBy(
        F.desc("salary_has_multiple_currencies"), F.desc("salary_length"), id_col
    ).limit(n)


def salary_outlier_examples(
    df: DataFrame, id_col: str = "id", col: str = "salary", n: int = 200
) -> DataFrame:
    """The n oddest pay texts."""
    return oddest(salary_length_flags(df.select(id_col, col), col), id_col, n)


def rules_from(mentions: DataFrame, patterns: DataFrame) -> DataFrame:
    """Candidate cleaning rules as (rule, rank, value, count, ratio) rows, from the two small reports."""
    columns = mentions.select(
        F.lit("high_salary_mention_columns").alias("rule"), F.col("column").alias("value"),
        F.lit(None).cast("long").alias("count"), F.col("salary_mention_ratio").alias("ratio"),
    )
    commonest = patterns.select(
        F.lit("top_salary_patterns").alias("rule"), F.col("salary_pattern").alias("value"), "count", "ratio"
    )
    # Both tables have at most a dozen rows here.
    order = Window.partitionBy("rule").orderBy(F.desc("ratio"), "value")
    found = columns.unionByName(commonest).withColumn("rank", F.row_number().over(order))
    fixed = [("remove_ambiguous_salary_keywords", i + 1, k, None, None) for i, k in enumerate(AMBIGUOUS_KEYWORDS)]
    default = str(Settings().remove_salary_mentions).lower()
    fixed.append(("default_remove_salary_mentions_for_clustering", 1, default, None, None))
    settings = mentions.sparkSession.createDataFrame(
        fixed, "rule string, rank int, value string, count long, ratio double")
    return found.where("rank <= 10").select(*settings.columns).unionByName(settings)


def rule_candidates(
    df: DataFrame, columns: Sequence[str] = LONG_TEXT_COLUMNS, col: str = "salary"
) -> DataFrame:
    """Mention columns by ratio, the ten commonest pay patterns with their counts, the fixed keyword list
    and whether mentions are removed by default."""
    return rules_from(salary_mention_ratio(df, columns), salary_pattern_summary(df, col))


def parse_audit(parsed: DataFrame) -> DataFrame:
    """Counts and shares of every parse status and every pattern, from one pass."""
    cells = _long(parsed, ["salary_parse_status", "salary_pattern"], lambda c: c)
    counts = cells.groupBy(F.col("column").alias("audit_type"), "value").count()
    half = counts.where("audit_type = 'salary_pattern'").agg(F.sum("count")).scalar()
    return counts.withColumn("ratio", F.col("count") / half)


def processing_summary(
    parsed: DataFrame, valid: DataFrame, split: DataFrame, settings: dict[str, object]
) -> DataFrame:
    """(metric, value) rows: rows per stage, settings, one row per parse status."""
    def metric(df: DataFrame, name: str | Column, value: Column) -> DataFrame:
        label = F.lit(name) if isinstance(name, str) else name
        return df.select(label.alias("metric"), value.cast("string").alias("value"))

    counts = F.count(F.lit(1))
    by_status = parsed.groupBy("salary_parse_status").agg(counts.alias("n"))
    stages = [
        metric(parsed.agg(counts.alias("n")), "raw_rows", F.col("n")),
        metric(valid.agg(counts.alias("n")), "salary_valid_rows_before_dedup", F.col("n")),
        metric(split.agg(counts.alias("n")), "rows_after_dedup", F.col("n")),
        metric(split.groupBy("split").agg(counts.alias("n")), F.concat("split", F.lit("_rows")), F.col("n")),
        metric(by_status, F.concat(F.lit("salary_status_"), "salary_parse_status"), F.col("n")),
    ]
    if settings:
        spark = parsed.sparkSession
        stages.append(spark.createDataFrame(
            [(k, str(v)) for k, v in settings.items()], "metric string, value string"
        ))
    result = stages[0]
    for stage in stages[1:]:
        result = result.unionByName(stage)
    return result


def split_ratio(df: DataFrame) -> DataFrame:
    return with_ratio(df.groupBy("split").agg(F.count(F.lit(1)).alias("rows")), "rows")


def split_distribution(
    df: DataFrame, col: str = "salary_expected_million_vnd", prefix: str = "salary"
) -> DataFrame:
    """Per split: rows, share, mean, median, sample deviation, extremes; ``prefix`` names them."""
    value = F.col(col)
    moments = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(value).alias(f"{prefix}_mean"),
        F.stddev_samp(value).alias(f"{prefix}_std"), F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
    )
    middle = quantiles(df, col, (0.5,), by=["split"]).select(
        "split", F.col("q")[0].alias(f"{prefix}_median")
    )
    return with_ratio(moments, "rows").join(middle, "split", "left").select(
        "split", "rows", "ratio",
        *[f"{prefix}_{m}" for m in ("mean", "median", "std", "min", "max")],
    )


def numeric_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, p1, p25, p50, p75, p99, max per column."""
    cells = _long(df, columns, lambda c: c.cast("double"))
    moments = cells.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    names = ("p1", "p25", "p50", "p75", "p99")
    shares = quantiles(cells, "value", (0.01, 0.25, 0.5, 0.75, 0.99), by=["column"])
    return moments.join(shares, "column", "left").select(
        "column", "count", "mean", "std", "min",
        *[F.col("q")[i].alias(name) for i, name in enumerate(names)], "max",
    )


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per split, and the most frequent train value (ties: the smallest)."""
    cells = _long(df, columns, lambda c: c.cast("string"), "split")
    counts = cells.groupBy("column", "split", "value").count()
    in_train, known = F.col("split") == "train", F.col("value").isNotNull()
    distinct = counts.groupBy("column").agg(
        F.count(F.when(in_train & known, 1)).alias("n_unique_train"),
        F.count(F.when(~in_train & known, 1)).alias("n_unique_test"),
    )
    top = ranked_values(df.where(in_train), columns, 1).select(
        "column", F.col("value").alias("top_train_value")
    )
    return distinct.join(top, "column", "left")


def dataset_overview(df: DataFrame, outlier: str = "is_salary_outlier") -> DataFrame:
    """Per split: rows, columns, null cells and their share, outlier share."""
    columns = [c for c in df.columns if c != "split"]
    nulls = sum((F.when(without_nan(df, c).isNull(), 1).otherwise(0) for c in columns), F.lit(0))
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(columns)).alias("features_per_sample"),
        F.sum(nulls).alias("missing_cells"),
        (F.sum(nulls) / (F.count(F.lit(1)) * len(columns))).alias("missing_cell_ratio"),
        F.avg(F.col(outlier).cast("int")).alias("salary_outlier_ratio"),
    )


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns per type; reads the schema only."""
    types = df.sparkSession.createDataFrame(
        [(t,) for _, t in df.dtypes], "dtype string"
    )
    return types.groupBy("dtype").count()


def histogram_table(
    df: DataFrame, col: str, bins: int, clip: float | Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest (clipped) value."""
    value = F.col(col).cast("double")
    if clip is not None:
        value = F.least(value, F.lit(clip) if isinstance(clip, (int, float)) else clip)
    clipped = df.where(F.col(col).isNotNull()).select(*by, value.alias("_v"))
    ends = clipped.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    low = F.col("_ends.lo")
    width = (F.col("_ends.hi") - low) / bins
    place = F.when(width > 0, F.floor((F.col("_v") - low) / width)).otherwise(F.lit(0))
    placed = with_row(clipped, "_ends", ends).select(
        *by, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), low.alias("_lo"), width.alias("_w")
    )
    return placed.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("count"), (F.min("_lo") + F.col("bin") * F.min("_w")).alias("bin_start")
    ).select(*by, "bin", "bin_start", "count")


def boxplot_table(
    df: DataFrame, col: str, by: str | None = None, top_groups: int | None = None
) -> DataFrame:
    """Quartiles and whiskers (1.5 times the quartile distance, no fliers) of each group.

    ``top_groups`` keeps the groups with the most rows; rows without a group are left out.
    """
    keys = [by] if by else []
    rows = df.select(*keys, F.col(col).cast("double").alias("_v")).where("_v IS NOT NULL")
    if by:
        rows = rows.where(F.col(by).isNotNull())
    if by and top_groups:
        kept = (
            df.where(F.col(by).isNotNull()).groupBy(by).count()
            .orderBy(F.desc("count"), by).limit(top_groups).select(by)
        )
        rows = rows.join(F.broadcast(kept), by, "left_semi")
    boxes = quantiles(rows, "_v", (0.25, 0.5, 0.75), by=keys)
    q = F.col("q")
    boxes = boxes.select(
        *keys, "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - 1.5 * (q[2] - q[0])).alias("_low"), (q[2] + 1.5 * (q[2] - q[0])).alias("_high"),
    )
    if by:
        boxes = small_side(boxes)
        fenced = rows.join(boxes, by)
    else:
        fenced = with_row(rows, "_box", boxes.select("_low", "_high")).select("_v", "_box.*")
    whiskers = fenced.where(F.col("_v").between(F.col("_low"), F.col("_high"))).groupBy(*keys).agg(
        F.min("_v").alias("whisker_low"), F.max("_v").alias("whisker_high")
    )
    if by:
        result = boxes.join(whiskers, by, "left")
    else:
        result = with_row(boxes, "_w", whiskers).select("*", "_w.*").drop("_w")
    return result.drop("_low", "_high")


def category_share_by_group(df: DataFrame, by: str, col: str, n: int = 10) -> DataFrame:
    """Share of the n commonest values inside each group; 0 where a value does not occur."""
    named = df.select(by, T.value_or_unknown(F.col(col)).alias("value"))
    counts = named.groupBy(by, "value").count()
    top = (
        counts.groupBy("value").agg(F.sum("count").alias("total"))
        .orderBy(F.desc("total"), "value").limit(n)
    )
    kept = counts.join(F.broadcast(top.select("value")), "value")
    sizes = counts.groupBy(by).agg(F.sum("count").alias("size"))
    # n values are listed inside every group row, so absent pairs come without a cross join.
    listed = top.agg(F.sort_array(F.collect_list("value"))).scalar()
    grid = sizes.select(by, "size", F.explode(listed).alias("value"))
    return grid.join(kept, [by, "value"], "left").select(
        by, "value", (F.coalesce("count", F.lit(0)) / F.col("size")).alias("ratio")
    )


def pivot_metrics(metrics: DataFrame, metric: str, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """k by (model, feature space) table of one metric."""
    name = F.concat_ws("_", "model", "feature_space")
    wide = metrics.withColumn("_pair", name).groupBy("k")
    names = [f"{m}_{s}" for m, s in pairs] if pairs else None
    return (wide.pivot("_pair", names) if names else wide.pivot("_pair")).agg(F.avg(metric))


def flag_ratio(df: DataFrame, flag: str = "is_salary_outlier") -> DataFrame:
    label = F.when(F.col(flag), "outlier").otherwise(F.lit("not_outlier"))
    return with_ratio(df.groupBy(label.alias("label")).count())


def outlier_examples(
    df: DataFrame, id_col: str = "id", flag: str = "is_salary_outlier", n: int = 200
) -> DataFrame:
    """The first n flagged rows, train before test."""
    rank = F.when(F.col("split") == "train", 0).otherwise(1)
    return first_n(df.where(F.col(flag)), n, [rank, F.col(id_col)])


def data_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DATA_DICTIONARY, "column string, role string, description string")


def group_size(df: DataFrame, by: str = "cluster_id") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("size")).orderBy(by)
