import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmine.operators import cluster_profiles as P
from jobmine.operators import clustering, scoring


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(1, 7, [0.0, 0.0]), (2, 7, [0.0, 2.0]), (3, 9, [10.0, 0.0]), (4, 9, [10.0, 2.0])]
    return spark.createDataFrame(rows, "id long, cluster_id int, features array<double>")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 0.3, size=(n, 3)) for c, n in ((0, 60), (5, 30), (-6, 10))])
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, features array<double>").persist()


def test_scores_of_four_points_by_hand(tiny):
    far = (10 + math.sqrt(104)) / 2
    assert scoring.silhouette(tiny).first()[0] == pytest.approx((far - 2) / far)
    assert scoring.davies_bouldin(tiny).first()[0] == pytest.approx(0.2)
    assert scoring.calinski_harabasz(tiny).first()[0] == pytest.approx((100 / 1) / (4 / 2))


def test_scores_equal_brute_force(spark, blobs):
    rows = blobs.withColumn("cluster_id", (F.col("id") % 4).cast("int")).where("id < 99")
    rows = rows.unionByName(rows.where("id = 0").select(F.lit(999).alias("id"), "features", F.lit(8).alias("cluster_id")))
    held = rows.collect()
    x, c = np.array([r["features"] for r in held]), np.array([r["cluster_id"] for r in held])
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        if (c == c[i]).sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(gaps[i, c == o].mean() for o in set(c) - {c[i]})
        scores.append((b - a) / max(a, b))
    assert scoring.silhouette(rows.repartition(5)).first()[0] == pytest.approx(np.mean(scores), abs=1e-7)
    centers = {o: x[c == o].mean(axis=0) for o in set(c)}
    spread = {o: np.sqrt(((x[c == o] - m) ** 2).sum(axis=1)).mean() for o, m in centers.items()}
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(centers[i] - centers[j]) for j in centers if j != i) for i in centers]
    assert scoring.davies_bouldin(rows).first()[0] == pytest.approx(np.mean(worst))


def test_coincident_centers_and_one_cluster(spark, tiny):
    rows = [(1, 1, [0.0]), (2, 1, [2.0]), (3, 2, [0.0]), (4, 2, [2.0]), (5, 3, [10.0])]
    same = spark.createDataFrame(rows, "id long, cluster_id int, features array<double>")
    assert scoring.davies_bouldin(same).first()[0] == pytest.approx(1 / 9)
    assert scoring.davies_bouldin(tiny.where("cluster_id = 7")).first()[0] is None


def test_silhouette_needs_a_sample_and_two_clusters(tiny, monkeypatch):
    with pytest.raises(ValueError, match="two clusters"):
        scoring.silhouette(tiny.where("cluster_id = 7"))
    monkeypatch.setattr(scoring, "MAX_SILHOUETTE_ROWS", 3)
    with pytest.raises(ValueError, match="draw a sample"):
        scoring.silhouette(tiny)


def test_equal_quotas():
    assert scoring.equal_quotas({"a": 3, "b": 1000, "c": 20}, 100) == {"a": 3, "c": 20, "b": 77}
    assert scoring.equal_quotas({"a": 3, "b": 4}, 100) == {"a": 3, "b": 4}
    assert sum(scoring.equal_quotas(dict.fromkeys(range(7), 50), 100).values()) == 100


def test_weighted_silhouette_of_small_clusters(spark):
    rng = np.random.default_rng(11)
    sizes = (6000, 2994, 6)  # a thousandth of the rows is near another cluster
    centers = ((0, 0), (4, 0), (4, 1.5))
    x = np.concatenate([rng.normal(c, 0.8, size=(n, 2)) for c, n in zip(centers, sizes, strict=True)])
    rows = [(i, int(c), p.tolist()) for i, (c, p) in enumerate(zip(np.repeat(range(3), sizes), x, strict=True))]
    rows.append((9999, None, [0.0, 0.0]))
    df = spark.createDataFrame(rows, "id long, cluster_id int, features array<double>").repartition(4)
    full = scoring.silhouette(df.where("cluster_id IS NOT NULL")).first()[0]
    for seed in (1, 2):
        found = scoring.weighted_silhouette(df, 600, seed=seed).first()
        assert (found["sample_rows"], found["clusters"]) == (600, 3)
        assert 0 < found["standard_error"] < 0.02
        assert abs(found["silhouette"] - full) < 3 * found["standard_error"]
    whole = scoring.weighted_silhouette(df, 20_000).first()
    assert whole["silhouette"] == pytest.approx(full) and whole["standard_error"] == 0
    with pytest.raises(ValueError, match="too many clusters"):
        scoring.weighted_silhouette(df, 5)


def test_balance(tiny):
    found = scoring.cluster_balance(tiny.where("id < 4")).first()
    assert (found["min_cluster_size"], found["max_cluster_size"]) == (1, 2)
    assert found["cluster_size_cv"] == pytest.approx(1 / 3)


def test_kmeans_finds_blobs_and_numbers_them_by_size(blobs):
    model = clustering.renumbered(clustering.kmeans_fit(blobs, 3, restarts=3, max_iter=20), blobs)
    assigned = clustering.assign_cluster(blobs, model.centers)
    assert [r["count"] for r in assigned.groupBy("cluster_id").count().orderBy("cluster_id").collect()] == [60, 30, 10]
    assert clustering.inertia(blobs, model.centers).first()[0] == pytest.approx(model.inertia)


def test_more_restarts_do_not_worsen(blobs):
    costs = [clustering.kmeans_fit(blobs, 6, restarts=n, max_iter=5).inertia for n in (1, 2, 4)]
    assert costs == sorted(costs, reverse=True)


def test_minibatch(blobs):
    model = clustering.minibatch_kmeans_fit(blobs, 3, batch_size=40, max_batches=12)
    full = clustering.kmeans_fit(blobs, 3, restarts=2, max_iter=20)
    assert model.k == 3 and model.inertia < full.inertia * 1.5


def planted_clusters(spark, sizes, parts):
    """Tight clusters on a circle, the given numbers of rows in each; ids repeat."""
    rows = [(n % 7, [20 * math.cos(c) + (n % 5) / 50, 20 * math.sin(c) + (n % 3) / 50]) for c, size in enumerate(sizes) for n in range(size)]
    return spark.createDataFrame(rows, "id long, features array<double>").repartition(parts)


def test_a_batch_lies_in_all_tasks(spark, monkeypatch):
    read = []
    monkeypatch.setattr(clustering, "_feed_starved", lambda centers, seen, batch, *more: read.append(batch))
    model = clustering.minibatch_kmeans_fit(planted_clusters(spark, [300, 300, 300], 6), 3, batch_size=100, passes=2)
    assert model.inertia < 3 and model.fit_rows == 900
    batch = read[0]
    assert len({f.split("/")[-1].split("-")[1] for f in batch.inputFiles() if "/batch=0/" in f}) == 6
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "Exchange" not in plan


def test_all_starts_are_scored_in_one_pass(spark):
    points = planted_clusters(spark, [40] * 6, 2)
    starts = [np.array([[20.0, 0.0], [0.0, 0.0]]), np.array([[0.0, 0.0]]), np.zeros((2, 2))]
    held = np.array([r["features"] for r in points.collect()])
    want = [((held[:, None, :] - s[None]) ** 2).sum(2).min(1).sum() for s in starts]
    assert clustering._costs(points, starts) == pytest.approx(want)
    found = clustering.scored_starts(points.select("features"), points, 6, 10, 1)
    assert clustering._costs(points, [found])[0] < 1


def test_starved_centers_move_to_rows(spark):
    batch = planted_clusters(spark, [50, 50], 2).withColumn("draw", F.xxhash64("features"))
    centers, seen = np.array([[20.0, 0.0], [900.0, 900.0], [11.0, 17.0]]), np.array([500.0, 0.0, 450.0])
    clustering._feed_starved(centers, seen, batch, 0.01, 100, 3)
    held = [r["features"] for r in batch.collect()]
    assert centers[1].tolist() in held and seen[1] == 450 and list(centers[0]) == [20.0, 0.0]


def test_too_few_distinct_rows(spark):
    with pytest.raises(ValueError, match="cannot start 4"):
        clustering.minibatch_kmeans_fit(spark.createDataFrame([(i, [float(i % 3)]) for i in range(30)], "id long, features array<double>"), 4)


def test_fit_on_sample(blobs):
    model = clustering.fit_on_sample(blobs, lambda df: clustering.kmeans_fit(df, 2, 1, 5), 50)
    assert (model.fit_rows, model.fit_note) == (50, "fit_on_sample_50")
    full = clustering.fit_on_sample(blobs, lambda df: clustering.kmeans_fit(df, 2, 1, 5), 5_000)
    assert (full.fit_rows, full.fit_note) == (100, "fit_full_train")


def test_model_round_trip(spark, blobs, tmp_path):
    model = clustering.kmeans_fit(blobs, 2, 1, 5)
    model.table(spark).write.parquet(str(tmp_path / "model"))
    read = clustering.ClusterModel.from_table(spark.read.parquet(str(tmp_path / "model")))
    assert read.centers == pytest.approx(model.centers) and read.inertia == model.inertia


def test_grid_and_ranking(blobs):
    specs = clustering.grid_specs(None, 1, 5, 40, 42, 5)
    metrics, models = clustering.run_grid({"svd": blobs, "svd10_l2": blobs}, (2, 3), specs, scoring.evaluate_clusters)
    ranked = scoring.rank_models(metrics)
    assert ranked.count() == 6 and len(models) == 6
    assert {(r["eval_rows"], r["fit_rows"], r["fit_sample_rows"]) for r in ranked.collect()} == {(100, 100, None)}
    sampled, _ = clustering.run_grid({"svd": blobs}, (2,), clustering.grid_specs(50, 1, 5, 40, 42, 5)[:1], scoring.evaluate_clusters)
    assert sampled.select("fit_rows", "fit_sample_rows", "eval_rows").first() == (50, 50, 100)
    assert scoring.pick_best(ranked).first()["total_rank"] == ranked.first()["total_rank"]


def test_ranks_share_ties(spark):
    rows = [("a", 0.5, 1.0, 10.0, 0.1), ("b", 0.5, 2.0, 20.0, 0.2), ("c", 0.4, 3.0, 5.0, 0.3)]
    df = spark.createDataFrame(rows, "model string, silhouette double, davies_bouldin double, calinski_harabasz double, cluster_size_cv double")
    found = {r["model"]: (r["rank_silhouette"], r["total_rank"]) for r in scoring.rank_models(df).collect()}
    assert found == {"a": (1, 4.5), "b": (1, 5.0), "c": (3, 10.5)}
    gains = {r["metric"]: r["gain"] for r in scoring.compare_to_baseline(df.where("model = 'a'"), df.where("model = 'b'")).collect()}
    assert gains == {"silhouette": 0.0, "davies_bouldin": 1.0, "calinski_harabasz": -10.0}


def profile_rows(spark):
    rows = [
        (1, 0, 10.0, " Dev ", "it", "junior"), (2, 0, 20.0, "Dev", "it", None), (3, 0, 30.0, "qa", "it", ""),
        (4, 1, 5.0, None, "sale", "senior"),
    ]
    return spark.createDataFrame(
        rows, "id long, cluster_id int, salary_expected_million_vnd double, job_title string, job_industry string, experience_level string")


def test_profiles(spark):
    found = {r["cluster_id"]: r for r in P.cluster_profiles(profile_rows(spark)).collect()}
    assert found[0]["top_job_title"] == "Dev (2); qa (1)" and found[0]["salary_median"] == 20.0
    assert found[0]["top_experience_level"] == "unknown (2); junior (1)"
    assert found[0]["suggested_cluster_label"] == "it - Dev" and found[0]["cluster_ratio"] == 0.75
    assert found[1]["suggested_cluster_label"] == "sale - unknown" and found[1]["top_keywords"] == ""


def test_labels_fall_back(spark):
    rows = [(1, "job_industry", "it", 1, 1), (2, "job_title", "dev", 1, 1), (3, "job_industry", "it", 1, 1), (3, "experience_level", "junior", 1, 1), (4, "other", "x", 1, 1)]
    ranked = spark.createDataFrame(rows, "cluster_id int, column string, value string, count long, rank int")
    found = {r["cluster_id"]: r["suggested_cluster_label"] for r in P.suggest_label(ranked).collect()}
    assert found == {1: "it", 2: "dev", 3: "it - junior", 4: "cluster_4"}


def test_label_template_keeps_what_was_written(spark):
    profiles = P.cluster_profiles(profile_rows(spark))
    fresh = P.label_template(profiles)
    assert {r["manual_cluster_label"] for r in fresh.collect()} == {""}
    existing = spark.createDataFrame([(0, "Công nghệ"), (1, "  ")], "cluster_id int, manual_cluster_label string")
    template = P.label_template(profiles, existing)
    labels = {r["cluster_id"]: r["cluster_label"] for r in P.attach_labels(profile_rows(spark), template).collect()}
    assert labels == {0: "Công nghệ", 1: "sale - unknown"}
    mapped = P.apply_label_map(profile_rows(spark), P.label_map(spark, {0: "x"}))
    assert {r["cluster_id"]: r["cluster_label"] for r in mapped.collect()} == {0: "x", 1: None}


def test_keywords_count_absent_terms_as_zero(spark):
    weights = spark.createDataFrame([(1, [0], [0.9]), (2, [1], [0.5]), (3, [1], [0.5]), (4, [], [])], "id long, term_idx array<int>, weight array<double>")
    clusters = profile_rows(spark).select("id", "cluster_id")
    vocabulary = spark.createDataFrame([(0, "aa"), (1, "bb")], "term_idx int, term string")
    found = {r["cluster_id"]: r["top_keywords"] for r in P.top_keywords(weights, clusters, vocabulary).collect()}
    assert found == {0: "bb; aa"}
    rows = weights.join(clusters, "id").select("cluster_id", "term_idx", "weight").collect()
    beside = spark.createDataFrame(rows, "cluster_id int, term_idx array<int>, weight array<double>")
    direct = P.top_keywords(beside, None, vocabulary)
    assert {r["cluster_id"]: r["top_keywords"] for r in direct.collect()} == {0: "bb; aa"}
    assert direct._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # sizes and names


def test_demo_rows_use_the_columns_there_are(spark):
    demo = P.demo_rows(profile_rows(spark), 2)
    assert demo.count() == 2 and "location" not in demo.columns


def test_silhouette_holds_a_bounded_number_of_distances(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(int(c), rng.normal(size=3).tolist()) for c in rng.integers(0, 3, 1_200)]
    df = spark.createDataFrame(rows, "cluster_id int, features array<double>").coalesce(1)
    wanted, inner, most = scoring.silhouette(df).first()[0], scoring.squared_distances, 1 << 19

    def bounded(points, others):
        if len(points) * len(others) > most:
            raise AssertionError("too many distances at once")
        return inner(points, others)

    monkeypatch.setattr(scoring, "squared_distances", bounded)
    assert scoring.silhouette(df).first()[0] == pytest.approx(wanted, abs=1e-12)
    monkeypatch.setattr(scoring, "_DISTANCES", 7)  # fewer than a row has
    assert scoring.silhouette(df.limit(60)).first()[0] is not None
    points, own = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    sums = np.stack([gaps[:, own == c].sum(1) for c in range(3)], 1)
    sizes, at = np.bincount(own), np.arange(len(own))
    inside = sums[at, own] / (sizes[own] - 1)
    means = sums / sizes
    means[at, own] = np.inf
    outside = means.min(1)
    assert wanted == pytest.approx(((outside - inside) / np.maximum(inside, outside)).mean(), abs=1e-9)
