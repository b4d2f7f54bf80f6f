"""What each cluster is about: sizes, pay, common values, keywords and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmine.config import DEMO_COLUMNS, PROFILE_COLUMNS
from jobmine.functions import text as T
from jobmine.operators.ordered import quantiles, sample_n
from jobmine.operators.profiling import ranked_values
from jobmine.operators.rows import small_side


def _named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trimmed values; null and blank become ``unknown``."""
    stripped = {c: T.strip(T.value_or_unknown(F.col(c))) for c in columns}
    return df.withColumns({c: F.when(v == "", T.UNKNOWN).otherwise(v) for c, v in stripped.items()})


def top_values_by_group(df: DataFrame, by: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """(group, column, value, count, rank) of the commonest values."""
    return ranked_values(_named(df.select(by, *columns), columns), columns, n, [by])


def values_text(ranked: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """One row per group, one ``top_<column>`` text ``"value (count); ..."`` per column."""
    def text(column: str) -> Column:
        entry = F.struct("rank", F.concat("value", F.lit(" ("), "count", F.lit(")")).alias("t"))
        listed = F.sort_array(F.collect_list(F.when(F.col("column") == column, entry)))
        return F.array_join(F.transform(listed, lambda e: e["t"]), "; ")

    return ranked.groupBy(by).agg(*[text(c).alias(f"top_{c}") for c in columns])


def top_values_text(df: DataFrame, by: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    return values_text(top_values_by_group(df, by, columns, n), by, columns)


def top_keywords(
    weights: DataFrame, clusters: DataFrame | None, vocabulary: DataFrame, n: int = 10,
    by: str = "cluster_id", id_col: str = "id",
) -> DataFrame:
    """Terms with the highest mean weight in each cluster; rows without a term count as zero.

    ``weights`` holds one row per document with its term arrays and its cluster, so no document is
    joined: sums are combined per task and shuffled by cluster and term. Only if the cluster is known
    in another table alone (``clusters``) are the two joined on the document id; else that table, if
    given, only supplies the sizes. Term numbers stand for terms until the few best are left; they
    are in order of the terms.
    """
    placed = weights if by in weights.columns else weights.join(clusters.select(id_col, by), id_col)
    sizes = small_side((placed if clusters is None else clusters).groupBy(F.col(by).alias("_of")).agg(
        F.count(F.lit(1)).alias("_size")))
    cells = placed.select(by, F.inline_outer(F.arrays_zip("term_idx", "weight"))).where("term_idx IS NOT NULL")
    totals = cells.groupBy(by, "term_idx").agg(F.sum("weight").alias("_total"))
    means = totals.join(sizes, F.col(by) == F.col("_of")).select(
        by, "term_idx", (F.col("_total") / F.col("_size")).alias("mean"))
    # Means are rounded before they are ranked: equal means must not be told apart by the order
    # in which a cluster's weights were added.
    order = Window.partitionBy(by).orderBy(F.desc(F.round("mean", 9)), "term_idx")
    best = means.where("mean > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    named = best.join(F.broadcast(vocabulary.select("term_idx", "term")), "term_idx")
    listed = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return named.groupBy(by).agg(
        F.array_join(F.transform(listed, lambda e: e["term"]), "; ").alias("top_keywords")
    )


def suggest_label(
    ranked: DataFrame, by: str = "cluster_id", industry: str = "job_industry",
    title: str = "job_title", experience: str | None = "experience_level",
) -> DataFrame:
    """A label per cluster from its commonest values.

    ``industry - title``, else ``industry - experience``, else any of them, else ``cluster_<id>``.
    Without ``experience`` the present ones of industry and title are joined.
    """
    def first(column: str | None) -> Column:
        if column is None:
            return F.lit(None).cast("string")
        value = F.max(F.when((F.col("column") == column) & (F.col("rank") == 1), F.col("value")))
        return F.nullif(value, F.lit(""))

    found = ranked.groupBy(by).agg(
        first(industry).alias("_i"), first(title).alias("_t"), first(experience).alias("_e")
    )
    i, t, e = F.col("_i"), F.col("_t"), F.col("_e")
    dash = F.lit(" - ")
    label = F.coalesce(  # concat is null when a part is
        F.concat(i, dash, t), F.concat(i, dash, e), i, t, e, F.concat(F.lit("cluster_"), F.col(by))
    )
    return found.select(by, label.alias("suggested_cluster_label"))


def cluster_profiles(
    df: DataFrame, by: str = "cluster_id", salary: str = "salary_expected_million_vnd",
    columns: Sequence[str] = PROFILE_COLUMNS, keywords: DataFrame | None = None, n: int = 5,
    industry: str = "job_industry", title: str = "job_title",
    experience: str | None = "experience_level",
) -> DataFrame:
    """One row per cluster: size, share, pay statistics, common values, keywords, suggested label."""
    present = [c for c in columns if c in df.columns]
    value = F.col(salary)
    moments = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("cluster_size"), F.avg(value).alias("salary_mean"),
        F.min(value).alias("salary_min"), F.max(value).alias("salary_max"),
    )
    total = moments.agg(F.sum("cluster_size")).scalar()
    middle = quantiles(df, salary, (0.5,), [by]).select(by, F.col("q")[0].alias("salary_median"))
    ranked = top_values_by_group(df, by, present, n)
    labels = suggest_label(
        ranked, by, industry, title, experience if experience in present else None
    )
    profile = (
        moments.withColumn("cluster_ratio", F.col("cluster_size") / total)
        .join(middle, by, "left")
        .join(values_text(ranked, by, present), by, "left")
        .join(labels, by, "left")
    )
    if keywords is not None:
        profile = profile.join(keywords, by, "left")
    words = F.coalesce("top_keywords", F.lit("")) if keywords is not None else F.lit("")
    return profile.select(
        by, "cluster_size", "cluster_ratio", "salary_mean", "salary_median", "salary_min",
        "salary_max", *[f"top_{c}" for c in present], words.alias("top_keywords"),
        "suggested_cluster_label",
    )


def label_template(profiles: DataFrame, existing: DataFrame | None = None, by: str = "cluster_id") -> DataFrame:
    """Profiles with an empty label to fill in by hand; labels given earlier are kept."""
    template = profiles.select(
        by, "cluster_size", "top_job_industry", "top_job_title", "salary_mean",
        "suggested_cluster_label",
    )
    if existing is None:
        return template.withColumn("manual_cluster_label", F.lit(""))
    kept = existing.select(by, F.col("manual_cluster_label").alias("_kept"))
    return template.join(kept, by, "left").withColumn(
        "manual_cluster_label", F.coalesce("_kept", F.lit(""))
    ).drop("_kept")


def attach_labels(
    df: DataFrame, template: DataFrame, by: str = "cluster_id", out: str = "cluster_label"
) -> DataFrame:
    """The label given by hand, else the suggested one. The template has one row per cluster."""
    manual = F.coalesce("manual_cluster_label", F.lit(""))
    chosen = F.when(T.strip(manual) != "", manual).otherwise(
        F.coalesce("suggested_cluster_label", F.lit(""))
    )
    return df.join(small_side(template.select(by, chosen.alias(out))), by, "left")


def label_map(spark: SparkSession, labels: dict[int, str], by: str = "cluster_id") -> DataFrame:
    return spark.createDataFrame(list(labels.items()), f"{by} int, cluster_label string")


def apply_label_map(
    df: DataFrame, labels: DataFrame, by: str = "cluster_id", out: str = "cluster_label"
) -> DataFrame:
    """Overwrite a label column from one map; ids outside the map get null."""
    named = labels.select(by, F.col("cluster_label").alias(out))
    return df.drop(out).join(small_side(named), by, "left")


def demo_rows(
    labelled: DataFrame, n: int = 10, seed: int = 42, id_col: str = "id",
    columns: Sequence[str] = DEMO_COLUMNS,
) -> DataFrame:
    """A few scored rows, the same ones each time, with the columns that exist."""
    present = [c for c in columns if c in labelled.columns]
    return sample_n(labelled, n, id_col, seed).select(id_col, *[c for c in present if c != id_col])


def model_info(best: DataFrame, settings: dict[str, str]) -> DataFrame:
    """The best model's row with settings and rule texts as further columns."""
    return best.withColumns({k: F.lit(v) for k, v in settings.items()})
