"""Cluster quality, model ranking and comparison."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from jobmine.functions.vectors import matrix, squared_distance_to, squared_distances
from jobmine.operators import gates
from jobmine.operators.clustering import MAX_CLUSTERS, cluster_means, collect_centers
from jobmine.operators.ordered import mark_drawn, sample_n
from jobmine.session import stage

# The silhouette compares every row of a sample with every other; the sample has a fixed size.
MAX_SILHOUETTE_ROWS = 20_000
MAX_SILHOUETTE_BYTES = 256 * 1024 * 1024
_DISTANCES = 1 << 19  # between rows and the sample that a task holds at once: 4 MB


def _row_silhouettes(sample: DataFrame, by: str, col: str) -> DataFrame:
    """(c, s): cluster and Euclidean silhouette of each row of a sample of fixed size.

    The sample (checked) is broadcast; every task compares its own rows with it and adds up the
    distances per cluster, so no pair of rows is ever a row. A lone member of a cluster scores 0.
    """
    points = sample.select(F.col(by).alias("c"), F.col(col).cast("array<double>").alias("x"))
    held = points.limit(MAX_SILHOUETTE_ROWS + 1).collect()
    width = len(held[0]["x"]) if held else 0
    if len(held) > MAX_SILHOUETTE_ROWS or len(held) * width * 8 > MAX_SILHOUETTE_BYTES:
        raise ValueError(f"more than {MAX_SILHOUETTE_ROWS} rows or too wide: draw a sample first")
    labels = sorted({r["c"] for r in held})
    if len(labels) < 2:
        raise ValueError("a silhouette needs two clusters")
    position = {c: i for i, c in enumerate(labels)}
    codes = np.array([position[r["c"]] for r in held])
    order = np.argsort(codes, kind="stable")
    others = np.array([held[i]["x"] for i in order], dtype=float)
    sizes = np.bincount(codes, minlength=len(labels))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    shared, most = sample.sparkSession.sparkContext.broadcast(others), _DISTANCES

    @F.arrow_udf(DoubleType())
    def score(own: pa.Array, vectors: pa.Array) -> pa.Array:
        mine = np.array([position[c] for c in own.to_pylist()])
        batch = matrix(vectors, width)
        result = np.zeros(len(mine))
        step = max(1, most // len(shared.value))
        for a in range(0, len(mine), step):
            part = mine[a:a + step]
            gaps = np.sqrt(squared_distances(batch[a:a + step], shared.value))
            per_cluster = np.add.reduceat(gaps, starts, axis=1)
            at = np.arange(len(part))
            alone = sizes[part] == 1
            inner = per_cluster[at, part] / np.maximum(sizes[part] - 1, 1)
            means = per_cluster / sizes
            means[at, part] = np.inf
            outer = means.min(axis=1)
            larger = np.maximum(inner, outer)
            value = np.divide(outer - inner, larger, out=np.zeros(len(part)), where=larger > 0)
            result[a:a + step] = np.where(alone, 0.0, value)
        return pa.array(result)

    return points.select("c", score(F.col("c"), F.col("x")).alias("s"))


def silhouette(sample: DataFrame, by: str = "cluster_id", col: str = "features") -> DataFrame:
    """Mean Euclidean silhouette of a sample of fixed size. A lone member of a cluster scores 0."""
    return _row_silhouettes(sample, by, col).agg(F.avg("s").alias("silhouette"))


def equal_quotas(sizes: dict, rows: int) -> dict:
    """Rows to draw per group: as equal as the sizes allow, ``rows`` in all if there are as many."""
    quotas, left, open_groups = {}, rows, sorted(sizes, key=lambda g: (sizes[g], g))
    for at, group in enumerate(open_groups):  # small groups first, what they lack goes to larger ones
        quotas[group] = min(sizes[group], left // (len(open_groups) - at))
        left -= quotas[group]
    return quotas


def weighted_silhouette(
    df: DataFrame, rows: int = 10_000, by: str = "cluster_id", col: str = "features",
    id_col: str = "id", seed: int = 42,
) -> DataFrame:
    """Silhouette of the whole table, estimated from a sample with a quota for every cluster.

    A cluster of any size is in the sample, whole if it is small; clusters count by their full size.
    One row: ``silhouette``, its ``standard_error`` from the spread within clusters (0 if every row
    was drawn), ``sample_rows`` and ``clusters``. Raises for fewer than two rows per cluster; rows
    without a cluster take no part.
    """
    known = df.where(F.col(by).isNotNull())
    counted = known.groupBy(F.col(by).alias("c")).agg(F.count(F.lit(1)).alias("n")).take(MAX_CLUSTERS + 1)
    if len(counted) > MAX_CLUSTERS or rows < 2 * len(counted):
        raise ValueError("too many clusters for the sample")
    sizes = {r["c"]: r["n"] for r in counted}
    quotas = equal_quotas(sizes, rows)
    drawn = mark_drawn(known.select(id_col, by, col), id_col, quotas, by, sizes, seed, "_drawn")
    sample = stage(drawn.where("_drawn").select(by, col), "silhouette")
    found = _row_silhouettes(sample, by, col).groupBy("c").agg(
        F.avg("s").alias("mean"), F.var_samp("s").alias("spread"), F.count(F.lit(1)).alias("drawn")
    )
    size = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, n)])[F.col("c")]
    share = size / sum(sizes.values())
    error = share * share * (1 - F.col("drawn") / size) * F.coalesce("spread", F.lit(0.0)) / F.col("drawn")
    return found.agg(
        F.sum(share * F.col("mean")).alias("silhouette"), F.sqrt(F.sum(error)).alias("standard_error"),
        F.sum("drawn").alias("sample_rows"), F.count(F.lit(1)).alias("clusters"),
    )


def _geometry(df: DataFrame, by: str, col: str) -> tuple[DataFrame, list, np.ndarray, np.ndarray]:
    """Per cluster its size, spread and squares; the labels, the distances between centers and
    their squared distances to the overall mean.

    Centers are captured by the tasks instead of joined, so a large cluster is not one task.
    """
    labels, centers, sizes = collect_centers(cluster_means(df, by, col), by)
    index = F.create_map(*[F.lit(x) for i, c in enumerate(labels) for x in (c, i)])[F.col(by)]
    squared = squared_distance_to(F.col(col).cast("array<double>"), index.cast("int"), centers)
    measured = df.select(F.col(by).alias("c"), squared.alias("d2")).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.sqrt("d2")).alias("spread"), F.sum("d2").alias("within")
    )
    gaps = np.sqrt(((centers[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2))
    middle = (centers * sizes[:, None]).sum(axis=0) / sizes.sum()
    return measured, labels, gaps, ((centers - middle) ** 2).sum(axis=1)


def _davies_bouldin(measured: DataFrame, labels: list, gaps: np.ndarray) -> DataFrame:
    """From one row per cluster, as few as a model has; coincident centers do not count as close."""
    found = {r["c"]: r["spread"] for r in measured.select("c", "spread").collect()}
    spread = np.array([found[c] for c in labels])
    worst = ((spread[:, None] + spread[None, :]) / np.where(gaps == 0, np.inf, gaps)).max(axis=1)
    value = float(worst.mean()) if len(labels) > 1 else None
    return measured.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def _calinski_harabasz(measured: DataFrame, labels: list, apart: np.ndarray) -> DataFrame:
    """From one row per cluster; ``apart`` is each center's squared distance to the overall mean."""
    n, within, k = F.sum("n"), F.sum("within"), len(labels)
    distance = F.create_map(*[F.lit(x) for c, d in zip(labels, apart, strict=True) for x in (c, float(d))])
    between = F.sum(F.col("n") * distance[F.col("c")])
    ratio = (between / (k - 1)) / (within / (n - k))
    return measured.agg(F.when(within == 0, 1.0).otherwise(ratio).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, by: str = "cluster_id", col: str = "features") -> DataFrame:
    """Mean over clusters of the worst ratio of spreads to center distance. Lower is better."""
    measured, labels, gaps, _ = _geometry(df, by, col)
    return _davies_bouldin(measured, labels, gaps)


def calinski_harabasz(df: DataFrame, by: str = "cluster_id", col: str = "features") -> DataFrame:
    """Dispersion between clusters over dispersion within. Higher is better."""
    measured, labels, _, apart = _geometry(df, by, col)
    return _calinski_harabasz(measured, labels, apart)


def cluster_balance(df: DataFrame, by: str = "cluster_id") -> DataFrame:
    """Smallest and largest cluster, population deviation of the sizes, deviation over mean."""
    deviation = F.stddev_pop("n")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(
        F.min("n").alias("min_cluster_size"), F.max("n").alias("max_cluster_size"),
        deviation.alias("cluster_size_std"), (deviation / F.avg("n")).alias("cluster_size_cv"),
    )


def evaluate_clusters(
    labelled: DataFrame, sample_size: int = 10_000, seed: int = 42, id_col: str = "id",
    by: str = "cluster_id", col: str = "features", all_on_sample: bool = False,
) -> DataFrame:
    """One row with all scores: the silhouette on a fixed sample, the others on all rows.

    ``all_on_sample`` takes the two ratios of spreads and distances on the sample, too.
    """
    sample = sample_n(labelled.select(id_col, by, col), sample_size, id_col, seed).persist()
    measured, row = None, {}
    try:
        gates.require(gates.enough_clusters(sample, by))
        measured, labels, gaps, apart = _geometry(sample if all_on_sample else labelled, by, col)
        measured = measured.persist()
        for table in (
            silhouette(sample, by, col), _davies_bouldin(measured, labels, gaps),
            _calinski_harabasz(measured, labels, apart), cluster_balance(labelled, by),
        ):
            row.update(table.first().asDict())
        row["eval_rows"] = sample.count()
    finally:
        if measured is not None:
            measured.unpersist()
        sample.unpersist()
    return labelled.sparkSession.createDataFrame([tuple(row.values())], list(row))


def rank_models(metrics: DataFrame) -> DataFrame:
    """Minimum ranks of three scores and of balance, and their weighted total; one row per model."""
    def rank(column: str, ascending: bool):
        order = F.asc(column) if ascending else F.desc(column)
        return F.rank().over(Window.orderBy(order))

    ranked = metrics.withColumns({
        "rank_silhouette": rank("silhouette", False),
        "rank_davies_bouldin": rank("davies_bouldin", True),
        "rank_calinski_harabasz": rank("calinski_harabasz", False),
        "rank_cluster_balance": rank("cluster_size_cv", True),
    })
    total = (
        F.col("rank_silhouette") + F.col("rank_davies_bouldin") + F.col("rank_calinski_harabasz")
        + 0.5 * F.col("rank_cluster_balance")
    )
    return ranked.withColumn("total_rank", total).orderBy(
        "total_rank", F.desc("silhouette"), "davies_bouldin", F.desc("calinski_harabasz")
    )


def pick_best(ranked: DataFrame, status: str | None = None) -> DataFrame:
    """The best model; with a ``status`` column only models that ran count."""
    if status:
        return ranked.where(F.col(status) == "ok").orderBy("total_rank", F.desc("silhouette")).limit(1)
    return ranked.orderBy(
        "total_rank", F.desc("silhouette"), "davies_bouldin", F.desc("calinski_harabasz")
    ).limit(1)


def compare_to_baseline(tuned: DataFrame, baseline: DataFrame) -> DataFrame:
    """Gains of a tuned model over a baseline, one row per score; positive is better."""
    scores: Sequence[str] = ("silhouette", "davies_bouldin", "calinski_harabasz")

    def long(df: DataFrame, name: str) -> DataFrame:
        return df.unpivot([], list(scores), "metric", name)

    gain = F.col("tuned") - F.col("baseline")
    return long(tuned.select(*scores), "tuned").join(long(baseline.select(*scores), "baseline"), "metric").select(
        "metric", "baseline", "tuned",
        F.when(F.col("metric") == "davies_bouldin", -gain).otherwise(gain).alias("gain"),
    )
