"""Prepare new postings and give them the clusters of a trained model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from jobmine.config import Settings
from jobmine.operators import cleaning, cluster_profiles, clustering, preparation
from jobmine.operators import text_features as X
from jobmine.operators.salary import parse_salary, salary_range_width
from jobmine.plans.train import FeatureModel


def prepare_new(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Row-local preparation: parse, keep valid pay, clean, simplify, no outlier test."""
    parsed = salary_range_width(parse_salary(df, "salary", settings))
    valid = preparation.keep_valid(parsed, finite=False)
    cleaned = cleaning.simplify_location(cleaning.fill_unknowns(valid))
    return cleaning.final_text(preparation.scoring_flags(cleaned))


def assign_new(prepared: DataFrame, features: FeatureModel, centers: np.ndarray) -> DataFrame:
    """Append ``cluster_id`` using the stored vocabulary, factor and centers only. Narrow.

    The vectors are computed beside all other columns, so no row has to be joined back, and the
    texts themselves stay in the JVM.
    """
    weights = X.tfidf_transform(
        features.grams(prepared), features.tfidf, "grams", prepared.columns
    )
    vectors = features.low(X.svd_transform(weights, features.factor))
    return clustering.assign_cluster(vectors, centers).drop("features")


def score(
    df: DataFrame, features: FeatureModel, model: clustering.ClusterModel, labels: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    assigned = assign_new(prepare_new(df, settings), features, model.centers)
    return cluster_profiles.apply_label_map(assigned, labels)
