"""K-Means fits, grid runs and cluster assignment on ``id, features array<double>`` tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmine.functions import vectors as V
from jobmine.operators.ordered import sample_n
from jobmine.session import staging_dir

MAX_CENTER_BYTES = 64 * 1024 * 1024
MAX_CLUSTERS = 1_000
# A batch counts as better when the smoothed mean distance falls by this share.
_GAIN = 1e-4


@dataclass(frozen=True)
class ClusterModel:
    """Centers of a fitted model and how it was fitted. k by width numbers."""

    centers: np.ndarray
    model: str = "KMeans"
    inertia: float = float("nan")
    fit_rows: int = 0
    fit_note: str = "fit_full_train"
    seconds: float = 0.0

    @property
    def k(self) -> int:
        return len(self.centers)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, c.tolist(), self.model, self.inertia, self.fit_rows, self.fit_note, self.seconds)
            for i, c in enumerate(self.centers)
        ]
        return spark.createDataFrame(
            rows, "cluster_id int, center array<double>, model string, inertia double, "
            "fit_rows long, fit_note string, seconds double",
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> ClusterModel:
        rows = sorted(table.collect(), key=lambda r: r["cluster_id"])
        first = rows[0]
        return cls(
            np.array([r["center"] for r in rows]), first["model"], first["inertia"],
            first["fit_rows"], first["fit_note"], first["seconds"],
        )


def collect_centers(means: DataFrame, by: str) -> tuple[list, np.ndarray, np.ndarray]:
    """Labels, centers and sizes on the driver, after a check that they are as few as a model has."""
    rows = means.select(by, "center", "size").take(MAX_CLUSTERS + 1)
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    rows.sort(key=lambda r: r[by])
    centers = np.array([r["center"] for r in rows], dtype=float)
    return [r[by] for r in rows], centers, np.array([r["size"] for r in rows])


def cluster_means(df: DataFrame, by: str = "cluster_id", col: str = "features") -> DataFrame:
    """Mean vector and size of each cluster: one combined aggregate."""
    vector = array_to_vector(F.col(col).cast("array<double>"))
    return df.groupBy(by).agg(
        vector_to_array(Summarizer.mean(vector)).alias("center"), F.count(F.lit(1)).alias("size")
    )


def assign_cluster(
    df: DataFrame, centers: np.ndarray, col: str = "features", out: str = "cluster_id"
) -> DataFrame:
    """Append the nearest center, for train, test or new rows. Narrow."""
    if centers.nbytes > MAX_CENTER_BYTES:
        raise ValueError("the centers are too large to broadcast")
    return df.withColumn(out, V.nearest(F.col(col).cast("array<double>"), centers)["index"])


def inertia(df: DataFrame, centers: np.ndarray, col: str = "features") -> DataFrame:
    """Sum of squared distances to the nearest center."""
    found = df.select(V.nearest(F.col(col).cast("array<double>"), centers).alias("found"))
    return found.agg(F.sum("found.squared").alias("inertia"))


def renumbered(model: ClusterModel, df: DataFrame, col: str = "features") -> ClusterModel:
    """Clusters numbered by falling size, then by center, so that ids do not depend on the fit."""
    sizes = dict.fromkeys(range(model.k), 0)
    counted = assign_cluster(df, model.centers, col).groupBy("cluster_id").count().collect()
    sizes.update({r["cluster_id"]: r["count"] for r in counted})
    order = sorted(sizes, key=lambda i: (-sizes[i], tuple(model.centers[i])))
    return replace(model, centers=model.centers[order])


def kmeans_fit(
    df: DataFrame, k: int, restarts: int = 10, max_iter: int = 300, seed: int = 42,
    col: str = "features",
) -> ClusterModel:
    """Best of several parallel k-means++ starts, by the sum of squared distances."""
    points = df.select(array_to_vector(F.col(col).cast("array<double>")).alias("features"))
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    start = time.perf_counter()
    best = None
    try:
        rows = points.count()
        for attempt in range(restarts):
            fit = KMeans(k=k, maxIter=max_iter, seed=seed + attempt, initMode="k-means||").fit(points)
            cost = fit.summary.trainingCost
            if best is None or cost < best[0]:
                best = cost, np.array(fit.clusterCenters())
    finally:
        points.unpersist()
    return ClusterModel(
        best[1], "KMeans", float(best[0]), rows, "fit_full_train", time.perf_counter() - start
    )


def _plus_plus(points: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray | None:
    """K-means++ start: each center is drawn by squared distance, the best of a few candidates."""
    tries = 2 + int(np.log(k))
    centers = [points[draw.integers(len(points))]]
    apart = V.squared_distances(points, np.array(centers))[:, 0]
    while len(centers) < k:
        total = apart.sum()
        if total <= 0:
            return None  # fewer distinct rows than centers
        picked = np.minimum(np.searchsorted(np.cumsum(apart), draw.random(tries) * total), len(points) - 1)
        after = np.minimum(apart[:, None], V.squared_distances(points, points[picked]))
        best = int(after.sum(0).argmin())
        centers.append(points[picked[best]])
        apart = after[:, best]
    return np.array(centers)


def _costs(df: DataFrame, starts: list[np.ndarray], col: str = "features") -> list[float]:
    """Sum of squared distances to the nearest center for each of several sets of centers, in one pass:
    a number per set and task is added up."""
    def add_up(batches):
        total = np.zeros(len(starts))
        for batch in batches:
            points = V.matrix(batch.column(0), starts[0].shape[1])
            total += [V.squared_distances(points, centers).min(1).sum() for centers in starts]
        yield pa.RecordBatch.from_pydict({"start": np.arange(len(starts)), "cost": total})

    found = df.select(col).mapInArrow(add_up, "start long, cost double").groupBy("start").agg(F.sum("cost").alias("cost"))
    costs = {r["start"]: r["cost"] for r in found.collect()}
    return [costs.get(i, 0.0) for i in range(len(starts))]


def scored_starts(sample: DataFrame, scored_on: DataFrame, k: int, starts: int, seed: int) -> np.ndarray:
    """The best of several k-means++ starts. They are drawn from a bounded sample of rows (``sample``,
    at most ``MAX_CENTER_BYTES``) and all scored in one pass over ``scored_on``."""
    rows = sample.toArrow().column("features").combine_chunks()
    points = V.matrix(rows, len(rows[0])) if len(rows) else np.zeros((0, 1))
    draws = [np.random.default_rng(seed + i) for i in range(starts)]
    found = [c for c in (_plus_plus(points, k, draw) for draw in draws) if c is not None] if len(points) >= k else []
    if not found:
        raise ValueError(f"a sample of {len(points)} rows cannot start {k} clusters")
    return found[int(np.argmin(_costs(scored_on, found)))].copy()


def minibatch_kmeans_fit(
    df: DataFrame, k: int, batch_size: int = 4_096, max_batches: int = 100, patience: int = 10,
    restarts: int = 10, seed: int = 42, id_col: str = "id", col: str = "features", passes: int = 10,
    starved_share: float = 0.01,
) -> ClusterModel:
    """Centers moved by one batch after the other, each by its share of all rows seen so far.

    Every row is dealt by hash to one of at most ``max_batches`` batches, which hold more than
    ``batch_size`` rows if the table is larger. Each batch is a folder to which every task has
    written its rows, so a step reads that folder only and uses all cores at any size. The start is
    the best of ``restarts``, scored on another batch. A center with less than ``starved_share`` of the
    rows of the largest one is moved to a row of the batch, in the first half of all passes. Stops when
    the mean distance has not improved for ``patience`` batches, but not before all rows were seen.
    """
    start = time.perf_counter()
    spark, vector = df.sparkSession, F.col(col).cast("array<double>")
    total = df.count()
    batches = max(1, min(max_batches, -(-total // batch_size)))
    path = f"{staging_dir(spark)}/batches-{uuid.uuid4().hex}"
    own = F.xxhash64(F.lit(seed), id_col, vector)  # rows that share an id are spread too
    dealt = df.select(vector.alias("features"), own.alias("draw"), F.pmod(own, F.lit(batches)).cast("int").alias("batch"))
    dealt.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    order = [r["batch"] for r in stored.select("batch").distinct().orderBy("batch").collect()]  # max_batches at most
    if not order:
        raise ValueError("no rows to fit")

    def batch_of(step: int) -> DataFrame:
        return stored.where(F.col("batch") == order[step % len(order)])

    width = len(batch_of(0).first()["features"])
    most = max(k, min(3 * batch_size, MAX_CENTER_BYTES // (8 * width)))
    drawn = stored.where(F.col("batch").isin(order[:3])).orderBy(F.xxhash64("draw"), "draw").limit(most)
    centers = scored_starts(drawn.select("features"), batch_of(1), k, restarts, seed)
    seen = np.zeros(k)
    smoothed, best, waited = None, None, 0
    for step in range(passes * len(order)):
        placed = batch_of(step).select("features", V.nearest(F.col("features"), centers).alias("at"))
        found = placed.groupBy(F.col("at.index").alias("c")).agg(
            Summarizer.sum(array_to_vector("features")).alias("s"), F.count(F.lit(1)).alias("n"),
            F.sum("at.squared").alias("d"),
        ).collect()  # k rows
        rows = sum(r["n"] for r in found)
        for r in found:
            seen[r["c"]] += r["n"]
            centers[r["c"]] += (r["s"].toArray() - r["n"] * centers[r["c"]]) / seen[r["c"]]
        if 2 * step < passes * len(order):
            _feed_starved(centers, seen, batch_of(step), starved_share, rows, seed + step)
        mean = sum(r["d"] for r in found) / max(rows, 1)
        weight = min(1.0, 2.0 * rows / (total + 1))
        smoothed = mean if smoothed is None else smoothed * (1 - weight) + mean * weight
        if best is None or smoothed < best * (1 - _GAIN):
            best, waited = smoothed, 0
        else:
            waited += 1
            if waited >= patience and step + 1 >= len(order):
                break
    cost = inertia(df, centers, col).first()["inertia"]
    return ClusterModel(
        centers, "MiniBatchKMeans", float(cost), total, "fit_full_train", time.perf_counter() - start
    )


def _feed_starved(
    centers: np.ndarray, seen: np.ndarray, batch: DataFrame, share: float, rows: int, seed: int
) -> None:
    """Move centers that few rows came to (at most as many as half the batch has rows) to rows of the batch."""
    starved = np.flatnonzero(seen < share * seen.max())[:rows // 2]
    if not len(starved):
        return
    drawn = batch.orderBy(F.xxhash64(F.lit(seed), "draw"), "draw").limit(len(starved)).select("features").collect()
    for c, row in zip(starved, drawn, strict=False):
        centers[c] = row["features"]
    fed = np.ones(len(seen), bool)
    fed[starved] = False
    seen[starved] = seen[fed].min()


def fit_on_sample(
    df: DataFrame, fit: Callable[[DataFrame], ClusterModel], limit: int | None,
    seed: int = 42, id_col: str = "id",
) -> ClusterModel:
    """Fit on a fixed-size sample when the table is larger; the model still serves all rows."""
    if limit is None or df.count() <= limit:
        return fit(df)
    model = fit(sample_n(df, limit, id_col, seed))
    return replace(model, fit_note=f"fit_on_sample_{limit}", fit_rows=limit)


def grid_specs(
    fit_sample: int | None, restarts: int, max_iter: int, batch: int, seed: int, max_batches: int = 100
):
    """The three (model, space) pairs that are compared."""
    def full(df: DataFrame, k: int) -> ClusterModel:
        return kmeans_fit(df, k, restarts, max_iter, seed)

    def mini(df: DataFrame, k: int) -> ClusterModel:
        return minibatch_kmeans_fit(df, k, batch, max_batches, seed=seed)

    return (
        ("KMeans", "svd", full, fit_sample),
        ("MiniBatchKMeans", "svd", mini, None),
        ("KMeans", "svd10_l2", full, None),
    )


def run_grid(
    spaces: dict[str, DataFrame], k_values: Sequence[int], specs, score, seed: int = 42
) -> tuple[DataFrame, dict[tuple[str, str, int], ClusterModel]]:
    """Fit every (model, space, k) and score it; the loop runs over the few models only. The
    spaces should be stored tables, as they are read once per model.

    ``score(labelled)`` returns a one-row DataFrame for the labelled table of a model.
    """
    models, tables = {}, []
    for name, space, fit, limit in specs:
        data = spaces[space]
        for k in k_values:
            model = fit_on_sample(data, lambda df, k=k, fit=fit: fit(df, k), limit, seed)
            models[name, space, k] = model
            row = score(assign_cluster(data, model.centers)).first().asDict()
            tables.append((
                name, space, k, model.seconds, model.inertia, *[row[c] for c in SCORES],
                model.fit_note, model.fit_rows, None if model.fit_note == "fit_full_train" else limit,
            ))
    spark = next(iter(spaces.values())).sparkSession
    schema = (
        "model string, feature_space string, k int, train_time_sec double, inertia double, "
        "silhouette double, davies_bouldin double, calinski_harabasz double, min_cluster_size long, "
        "max_cluster_size long, cluster_size_std double, cluster_size_cv double, eval_rows long, fit_note string, "
        "fit_rows long, fit_sample_rows long"
    )
    return spark.createDataFrame(tables, schema), models


SCORES = (
    "silhouette", "davies_bouldin", "calinski_harabasz", "min_cluster_size", "max_cluster_size",
    "cluster_size_std", "cluster_size_cv", "eval_rows",
)
