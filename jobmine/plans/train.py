"""Text features, model grid, final model and cluster profiles of the train split."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmine.config import CLUSTER_LABELS_13, METADATA_COLUMNS, Settings
from jobmine.operators import cleaning, cluster_profiles, clustering, gates, scoring
from jobmine.operators import text_features as X
from jobmine.session import stage
from jobmine.sources import store


@dataclass(frozen=True)
class FeatureModel:
    """What is needed to turn a new text into the vectors the clusters live in."""

    tfidf: X.TfidfModel
    factor: np.ndarray
    low_dim: int
    ngram_max: int
    drop_first: bool = False

    def grams(self, df: DataFrame, text: str = "final_text") -> DataFrame:
        return X.tokenize_ngrams(df, text, "grams", 1, self.ngram_max, X.stop_tokens())

    def weights(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        return X.tfidf_transform(self.grams(df), self.tfidf, "grams", [id_col])

    def low(self, svd: DataFrame) -> DataFrame:
        return X.low_dimensional(svd, self.low_dim, self.drop_first)

    def placed(self, weights: DataFrame, centers: np.ndarray) -> DataFrame:
        """Term arrays with the cluster of their row, found on the row itself. Narrow."""
        kept = weights.withColumns({"_terms": F.col("term_idx"), "_weights": F.col("weight")})
        found = clustering.assign_cluster(self.low(X.svd_transform(kept, self.factor)), centers)
        return found.select("cluster_id", F.col("_terms").alias("term_idx"), F.col("_weights").alias("weight"))

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        flags = [(self.low_dim, self.ngram_max, self.drop_first)]
        return {
            "vocab": self.tfidf.table(spark), "svd_v": X.factor_table(spark, self.factor),
            "settings": spark.createDataFrame(flags, "low_dim int, ngram_max int, drop_first boolean"),
        }

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> FeatureModel:
        flags = tables["settings"].first()
        return cls(
            X.TfidfModel.from_table(tables["vocab"]), X.factor_from_table(tables["svd_v"]),
            flags["low_dim"], flags["ngram_max"], flags["drop_first"],
        )

    def save(self, spark: SparkSession, path: str) -> int:
        """Add the next version; a crash before its manifest leaves the version before in force."""
        return store.write_version(self.tables(spark), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> FeatureModel:
        return cls.from_tables(store.read_version(spark, path, version))


def save_models(
    spark: SparkSession, path: str, features: FeatureModel, model: clustering.ClusterModel
) -> int:
    """Feature model and centers as one version, so that neither is ever read with another's twin."""
    return store.write_version({**features.tables(spark), "centers": model.table(spark)}, path)


def load_models(
    spark: SparkSession, path: str, version: int | None = None
) -> tuple[FeatureModel, clustering.ClusterModel]:
    tables = store.read_version(spark, path, version)
    return FeatureModel.from_tables(tables), clustering.ClusterModel.from_table(tables["centers"])


@dataclass(frozen=True)
class Trained:
    features: FeatureModel
    model: clustering.ClusterModel
    metrics: DataFrame
    best: DataFrame
    gains: DataFrame
    clustered: DataFrame
    profiles: DataFrame
    summary: DataFrame
    info: DataFrame


def fit_features(
    df: DataFrame, settings: Settings = Settings(), drop_first: bool = False
) -> tuple[FeatureModel, DataFrame, DataFrame]:
    """Fit on ``id, final_text`` rows; returns the model, the term weights and the SVD vectors."""
    tokenized = X.tokenize_ngrams(
        df.select("id", "final_text"), "final_text", "grams", 1, settings.ngram_max, X.stop_tokens()
    )
    tfidf = X.TfidfModel.fit(tokenized, "grams", settings)
    weights = stage(X.tfidf_transform(tokenized, tfidf), "weights")
    factor = X.svd_fit(
        weights, len(tfidf.terms), weights.count(), settings.svd_components, seed=settings.seed
    )
    model = FeatureModel(tfidf, factor, settings.low_dim, settings.ngram_max, drop_first)
    return model, weights, stage(X.svd_transform(weights, factor), "svd")


def train(
    clean_train: DataFrame, settings: Settings = Settings(),
    labels: dict[int, str] = CLUSTER_LABELS_13,
) -> Trained:
    """Compare models over the grid, fit the final one and describe its clusters."""
    spark = clean_train.sparkSession
    rows = stage(cleaning.engineer(clean_train), "engineered")
    model, weights, svd = fit_features(rows, settings)
    low = stage(model.low(svd), "low")
    specs = clustering.grid_specs(
        settings.fit_sample, settings.restarts, settings.max_iter, settings.minibatch_size,
        settings.seed, settings.minibatch_steps,
    )
    metrics, _ = clustering.run_grid(
        {"svd": svd, "svd10_l2": low}, settings.k_values, specs,
        lambda labelled: scoring.evaluate_clusters(labelled, settings.eval_sample, settings.seed),
        settings.seed,
    )
    ranked = scoring.rank_models(metrics)

    final = clustering.kmeans_fit(low, settings.final_k, settings.restarts, settings.max_iter, settings.seed)
    final = clustering.renumbered(final, low)
    assigned = clustering.assign_cluster(low, final.centers)
    scores = scoring.evaluate_clusters(assigned, settings.eval_sample, settings.seed)
    metadata = rows.select(*[c for c in METADATA_COLUMNS if c in rows.columns])
    named = cluster_profiles.label_map(spark, labels)
    own = assigned.select(F.col("id").alias("_id"), "cluster_id")  # ``prepare`` may keep a row without an id
    placed = metadata.join(own, metadata["id"].eqNullSafe(own["_id"])).drop("_id")
    clustered = stage(cluster_profiles.apply_label_map(placed, named), "clustered")
    gates.require(gates.row_count(clustered, final.fit_rows, "clustered_rows"))
    keywords = cluster_profiles.top_keywords(
        model.placed(weights, final.centers), clustered.select("cluster_id"), model.tfidf.table(spark)
    )
    profiles = cluster_profiles.cluster_profiles(clustered, keywords=keywords)
    profiles = cluster_profiles.apply_label_map(profiles, named, out="manual_cluster_label")
    profiles = profiles.withColumn(
        "final_cluster_label", F.coalesce("manual_cluster_label", "suggested_cluster_label")
    )
    summary = X.feature_summary(spark, {
        "train_rows": final.fit_rows, "tfidf_features": len(model.tfidf.terms),
        "max_svd_components": model.factor.shape[1],
        "dropped_svd_components": int(model.drop_first),
        "low_dimensional_components": min(model.low_dim, model.factor.shape[1]),
        "random_state": settings.seed,
    })
    info = cluster_profiles.model_info(scores, {
        "model_name": final.model, "feature_space": "svd10_l2", "k": str(final.k),
        "fit_rows": str(final.fit_rows), "kmeans_fit_time_sec": str(final.seconds),
        "inertia": str(final.inertia),
        "selection_rule": "total_rank = rank_silhouette + rank_davies_bouldin "
        "+ rank_calinski_harabasz + 0.5 * rank_cluster_balance",
    })
    best = scoring.pick_best(ranked)
    gains = scoring.compare_to_baseline(scores, best)  # of the final model over the best of the grid
    return Trained(model, final, ranked, best, gains, clustered, profiles, summary, info)
