"""Text features, clustering, scores and cluster profiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.registry import SQL, check, longs, rounded
from checks.sql_text import grams_sql
from checks.tables import load, postings, scratch
from jobmine.config import Settings
from jobmine.operators import cluster_profiles as P
from jobmine.operators import clustering, gates, profiling, scoring
from jobmine.operators import text_features as X
from jobmine.plans import score as score_plan
from jobmine.plans import train as train_plan
from jobmine.session import stage
from jobmine.sources import tables as sources

STOP = X.stop_tokens()
SMALL = Settings(
    svd_components=20, k_values=(3,), final_k=4, restarts=2, max_iter=20,
    minibatch_size=256, minibatch_steps=10,
)


def texts(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")


def tokenized(spark, sf_dir):
    return X.tokenize_ngrams(texts(spark, sf_dir), "text", "grams", 1, 3, STOP)


DOCS = "(SELECT doc_id AS id, text, lang, source FROM documents)"
GRAMS_SQL = f"WITH {grams_sql(DOCS, 'text', 'id', 1, 3, STOP)}"
VOCAB_SQL = f"""{GRAMS_SQL}, totals AS (SELECT g AS term, count(*) AS tf, count(DISTINCT id) AS df FROM grams GROUP BY 1),
docs AS (SELECT count(*) AS n FROM documents),
top AS (SELECT term, tf, df, n FROM totals, docs WHERE df >= 20 AND df <= n * 0.4::DOUBLE ORDER BY tf DESC, term LIMIT 30000),
vocab AS (SELECT term, tf, df, row_number() OVER (ORDER BY term) - 1 AS term_idx,
  ln(CAST(1 + n AS DOUBLE) / (1 + df)) + 1 AS idf FROM top)"""
WEIGHTS_SQL = f"""{VOCAB_SQL}, tfs AS (SELECT id, g AS term, count(*) AS tf FROM grams GROUP BY 1, 2),
raw AS (SELECT id, term_idx, vocab.term, (1 + ln(CAST(tfs.tf AS DOUBLE))) * idf AS w FROM tfs JOIN vocab ON tfs.term = vocab.term),
weights AS (SELECT id, term_idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def fitted(spark, sf_dir):
    rows = tokenized(spark, sf_dir)
    model = X.TfidfModel.fit(rows)
    return model, X.tfidf_transform(rows, model, keep=["id", "lang"])


@check("tokenize_ngrams", f"{GRAMS_SQL} SELECT id, g AS gram, count(*) AS n FROM grams GROUP BY 1, 2")
def tokenize_ngrams(spark, sf_dir):
    return X.ngram_counts(tokenized(spark, sf_dir))


@check("stop_tokens_found", f"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents)
SELECT term, count(*) AS n FROM w WHERE term IN ({', '.join(f"'{s}'" for s in STOP)}) GROUP BY 1""")
def stop_tokens_found(spark, sf_dir):
    """How often each stop word of the fixed list occurs."""
    words = texts(spark, sf_dir).select(F.explode_outer(X.tokens(F.col("text"))).alias("term"))
    return words.where(F.col("term").isin(STOP)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@check("ngram_frequency", f"WITH {grams_sql(DOCS, 'text', 'id', 2, 3)} SELECT g AS ngram, count(*) AS freq FROM grams GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def ngram_frequency(spark, sf_dir):
    return X.ngram_frequency(texts(spark, sf_dir), "text", 2, 3)


@check("word_frequency", f"WITH {grams_sql(DOCS, 'text', 'id', 1, 1)} SELECT g AS ngram, count(*) AS freq FROM grams GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def word_frequency(spark, sf_dir):
    return X.ngram_frequency(texts(spark, sf_dir), "text", 1, 1)


@check("vocabulary", f"{VOCAB_SQL} SELECT term, term_idx, tf, df, round(idf, 6) AS idf FROM vocab")
def vocabulary(spark, sf_dir):
    found = X.select_vocabulary(tokenized(spark, sf_dir)).select("term", "term_idx", "tf", "df", "idf")
    return longs(rounded(found), "term_idx")


@check("tfidf_weights", f"{WEIGHTS_SQL} SELECT id, term_idx, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf_dir):
    _, weights = fitted(spark, sf_dir)
    return longs(rounded(X.weights_long(weights).select("id", "term_idx", "weight")), "term_idx")


@check("tfidf_transform", f"""{VOCAB_SQL}, {grams_sql('(SELECT conv_id * 1000 + turn AS id, text FROM conversations)', 'text', 'id', 1, 3, STOP).replace('words', 'new_words').replace('grams AS', 'new_grams AS')},
tfs AS (SELECT id, g AS term, count(*) AS tf FROM new_grams GROUP BY 1, 2),
raw AS (SELECT id, term_idx, (1 + ln(CAST(tfs.tf AS DOUBLE))) * idf AS w FROM tfs JOIN vocab ON tfs.term = vocab.term)
SELECT id, term_idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw""")
def tfidf_transform(spark, sf_dir):
    """Conversations weighed with the vocabulary of the documents."""
    model = X.TfidfModel.fit(tokenized(spark, sf_dir))
    new = load(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    weights = X.tfidf_transform(X.tokenize_ngrams(new, "text", "grams", 1, 3, STOP), model)
    return longs(rounded(X.weights_long(weights)), "term_idx")


@check("matrix_density", f"""{WEIGHTS_SQL} SELECT (SELECT n FROM docs) AS rows, (SELECT count(*) FROM weights) AS nnz,
  (SELECT count(*) FROM vocab) AS columns, round((SELECT count(*) FROM weights) / ((SELECT n FROM docs) * (SELECT count(*) FROM vocab)), 6) AS density""")
def matrix_density(spark, sf_dir):
    model, weights = fitted(spark, sf_dir)
    return rounded(X.matrix_density(weights, len(model.terms)))


@check("gate_leakage", f"""{WEIGHTS_SQL}, c AS (SELECT 'features_are_text' AS "check", 0 AS failures
  UNION ALL SELECT 'enough_terms', CASE WHEN (SELECT count(DISTINCT term_idx) FROM weights) > 1000 THEN 0 ELSE 1 END
  UNION ALL SELECT 'more_weights_than_rows', CASE WHEN (SELECT count(*) FROM weights) > (SELECT n FROM docs) THEN 0 ELSE 1 END)
SELECT "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM c""")
def gate_leakage(spark, sf_dir):
    _, weights = fitted(spark, sf_dir)
    rows = load(spark, sf_dir, "documents").count()
    return gates.no_leakage(X.weights_long(weights), ["text"], rows)


@check("feature_summary", f"""{VOCAB_SQL} SELECT 'tfidf_features' AS metric, CAST(count(*) AS DOUBLE) AS value FROM vocab
UNION ALL SELECT 'documents', CAST(n AS DOUBLE) FROM docs""")
def feature_summary(spark, sf_dir):
    rows = tokenized(spark, sf_dir)
    model = X.TfidfModel.fit(rows)
    return X.feature_summary(spark, {"tfidf_features": len(model.terms), "documents": rows.count()})


def _svd(spark, sf_dir):
    model, weights = fitted(spark, sf_dir)
    weights = stage(weights.select("id", "term_idx", "weight"), "weights")
    factor = X.svd_fit(weights, len(model.terms), weights.count(), 20)
    return weights, X.svd_transform(weights, factor)


@check("svd_features")
def svd_features(spark, sf_dir):
    return rounded_vectors(_svd(spark, sf_dir)[1])


def rounded_vectors(df, col: str = "features"):
    return df.withColumn(col, F.transform(col, lambda x: F.round(x, 4)))


@check("svd_variance")
def svd_variance(spark, sf_dir):
    weights, features = _svd(spark, sf_dir)
    return rounded(X.svd_variance(features, weights), digits=4)


@check("low_dimensional")
def low_dimensional(spark, sf_dir):
    return rounded_vectors(X.low_dimensional(_svd(spark, sf_dir)[1], 10, drop_first=True))


def planted_weights(spark, sf_dir):
    """Orders over five disjoint blocks of terms, one per priority: an order's weights are its price
    times the block's direction, so the matrix has rank five and SQL knows its decomposition."""
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice").cast("double") / 100000).alias("c"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("g"),
    )
    steps = F.sequence(F.lit(0), F.lit(11))
    rows = orders.select(
        "id", F.transform(steps, lambda j: F.col("g") * 3001 + j * 271).alias("term_idx"),
        F.transform(steps, lambda j: F.col("c") * (F.col("g") + 1) * (j + 1)).alias("weight"),
    )
    weights = stage(rows, "planted")
    return weights, X.svd_transform(weights, X.svd_fit(weights, 5 * 3001, weights.count(), 6))


PLANTED_SVD_SQL = """WITH o AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) / 100000 AS c,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS g FROM orders),
blocks AS (SELECT g, g * sqrt(650.0::DOUBLE) AS u, sum(c * c) AS s2, sum(c) AS s FROM o GROUP BY g),
ranked AS (SELECT *, row_number() OVER (ORDER BY u * u * s2 DESC) AS component,
  u * u * (s2 / n - (s / n) * (s / n)) AS v FROM blocks, (SELECT count(*) AS n FROM o))"""


@check("svd_features_planted", f"""{PLANTED_SVD_SQL}
SELECT id, component, round(c * u, 5) AS value FROM o JOIN ranked ON o.g = ranked.g""")
def svd_features_planted(spark, sf_dir):
    """The components that hold more than a rounding error of each order."""
    features = planted_weights(spark, sf_dir)[1].select("id", F.posexplode("features"))
    found = features.where("abs(col) > 1e-6")
    return rounded(found.select("id", (F.col("pos") + 1).cast("long").alias("component"), F.col("col").alias("value")), digits=5)


@check("svd_variance_planted", f"""{PLANTED_SVD_SQL}
SELECT component, round(u * sqrt(s2), 4) AS singular_value, round(v / sum(v) OVER (), 6) AS explained_variance_ratio,
  round(sum(v) OVER (ORDER BY component) / sum(v) OVER (), 6) AS cumulative_explained_variance FROM ranked
UNION ALL SELECT 6, 0, 0, 1""")
def svd_variance_planted(spark, sf_dir):
    """Singular values and variance; the sixth component is beyond the rank."""
    weights, features = planted_weights(spark, sf_dir)
    shares = X.svd_variance(features, weights).join(X.singular_values(features), "component")
    found = rounded(shares, "explained_variance_ratio", "cumulative_explained_variance")
    return longs(rounded(found, "singular_value", digits=4), "component")


def points(spark, sf_dir):
    """Embeddings as points; their label serves as a given cluster."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster_id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


POINTS_SQL = """WITH pts AS (SELECT vec_id AS id, label AS cluster_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
cells AS (SELECT id, cluster_id, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS p FROM pts),
dims AS (SELECT cluster_id, p, avg(v) AS c FROM cells GROUP BY 1, 2),
centers AS (SELECT cluster_id, list(c ORDER BY p) AS c FROM dims GROUP BY 1)"""
DISTANCE = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def centers(spark, sf_dir):
    return clustering.collect_centers(clustering.cluster_means(points(spark, sf_dir)), "cluster_id")[1]


@check("l2_normalize", f"""{POINTS_SQL}, s AS (SELECT id, list_transform(x, lambda v: v * 3 + 0.1) AS x FROM pts)
SELECT id, round(v, 6) AS v, p FROM (SELECT id, unnest(list_transform(x, lambda v: v / sqrt(list_sum(list_transform(x, lambda u: u * u))))) AS v,
  unnest(range(1, len(x) + 1)) AS p FROM s)""")
def l2_normalize(spark, sf_dir):
    stretched = points(spark, sf_dir).withColumn("features", F.transform("features", lambda v: v * 3 + 0.1))
    return _components(X.l2_normalize(stretched))


def _components(df):
    cells = df.select("id", F.posexplode("features").alias("pos", "v"))
    return rounded(cells.select("id", "v", (F.col("pos") + 1).cast("long").alias("p")))


@check("drop_first", "SELECT vec_id AS id, round(CAST(v AS DOUBLE), 6) AS v, p FROM (SELECT vec_id, unnest(embedding[2:]) AS v, unnest(range(1, len(embedding))) AS p FROM embeddings)")
def drop_first(spark, sf_dir):
    return _components(X.drop_first_component(points(spark, sf_dir)))


_NEAREST = f"""{POINTS_SQL}, d AS (SELECT id, centers.cluster_id AS c, {DISTANCE.format('x', 'c')} AS d FROM pts, centers),
near AS (SELECT id, arg_min(c, d) AS cluster_id, min(d) AS d FROM d GROUP BY 1)"""


@check("assign_cluster", f"{_NEAREST} SELECT id, cluster_id FROM near")
def assign_cluster(spark, sf_dir):
    return clustering.assign_cluster(points(spark, sf_dir).drop("cluster_id"), centers(spark, sf_dir)).drop("features")


@check("inertia", f"{_NEAREST} SELECT round(sum(d), 6) AS inertia FROM near")
def inertia(spark, sf_dir):
    return rounded(clustering.inertia(points(spark, sf_dir), centers(spark, sf_dir)))


# The sample of 10,000 holds all rows of a small table; the SQL draws it in the same way.
_SAMPLE = "sample AS (SELECT * FROM pts ORDER BY md5(concat('42:', id)), id LIMIT 10000)"


@check("silhouette", f"""{POINTS_SQL}, {_SAMPLE}, sizes AS (SELECT cluster_id, count(*) AS n FROM sample GROUP BY 1),
pairs AS (SELECT a.id, a.cluster_id AS own, b.cluster_id AS other,
  sum(sqrt(greatest({DISTANCE.format('a.x', 'b.x')}, 0))) AS total FROM sample a, sample b GROUP BY 1, 2, 3),
means AS (SELECT id, own, max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN total / (n - 1) END END) AS a,
  min(CASE WHEN own <> other THEN total / n END) AS b FROM pairs JOIN sizes ON other = cluster_id GROUP BY 1, 2)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM means""")
def silhouette(spark, sf_dir):
    from jobmine.operators.ordered import sample_n

    return rounded(scoring.silhouette(sample_n(points(spark, sf_dir), 10_000, "id")))


@check("weighted_silhouette", f"""{POINTS_SQL.replace('WITH', 'WITH RECURSIVE', 1)},
groups AS (SELECT cluster_id, count(*) AS n, row_number() OVER (ORDER BY count(*), cluster_id) - 1 AS at, count(*) OVER () AS k FROM pts GROUP BY 1),
fill AS (SELECT 0::BIGINT AS at, 300::BIGINT AS room UNION ALL
  SELECT fill.at + 1, room - least(n, room // (k - fill.at)) FROM fill JOIN groups ON groups.at = fill.at),
quotas AS (SELECT cluster_id, n, least(n, room // (k - fill.at)) AS quota FROM fill JOIN groups ON groups.at = fill.at),
numbered AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5(concat('42:', id)), id) AS r FROM pts),
sample AS (SELECT id, cluster_id, x FROM numbered JOIN quotas USING (cluster_id) WHERE r <= quota),
pairs AS (SELECT a.id, a.cluster_id AS own, b.cluster_id AS other,
  sum(sqrt(greatest({DISTANCE.format('a.x', 'b.x')}, 0))) AS total FROM sample a, sample b GROUP BY 1, 2, 3),
means AS (SELECT id, own, max(CASE WHEN own = other THEN CASE WHEN quota > 1 THEN total / (quota - 1) END END) AS a,
  min(CASE WHEN own <> other THEN total / quota END) AS b FROM pairs JOIN quotas ON other = cluster_id GROUP BY 1, 2),
scores AS (SELECT own, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM means),
parts AS (SELECT own, avg(s) AS m, coalesce(var_samp(s), 0) AS v, count(*) AS drawn FROM scores GROUP BY 1),
shares AS (SELECT m, v, drawn, n, n / (SELECT count(*) FROM pts)::DOUBLE AS w FROM parts JOIN quotas ON own = cluster_id)
SELECT round(sum(w * m), 6) AS silhouette, round(sqrt(sum(w * w * (1 - drawn / n::DOUBLE) * v / drawn)), 6) AS standard_error,
  sum(drawn)::BIGINT AS sample_rows, count(*) AS clusters FROM shares""")
def weighted_silhouette(spark, sf_dir):
    """The whole table's silhouette from 300 rows, as many of each cluster as there can be."""
    return rounded(scoring.weighted_silhouette(points(spark, sf_dir), 300))


@check("davies_bouldin", f"""{POINTS_SQL}, s AS (SELECT pts.cluster_id, avg(sqrt({DISTANCE.format('x', 'c')})) AS s, any_value(c) AS c
  FROM pts JOIN centers ON pts.cluster_id = centers.cluster_id GROUP BY 1),
w AS (SELECT a.cluster_id, max((a.s + b.s) / sqrt({DISTANCE.format('a.c', 'b.c')})) AS w FROM s a, s b WHERE a.cluster_id <> b.cluster_id GROUP BY 1)
SELECT round(avg(w), 6) AS davies_bouldin FROM w""")
def davies_bouldin(spark, sf_dir):
    return rounded(scoring.davies_bouldin(points(spark, sf_dir)))


@check("calinski_harabasz", f"""{POINTS_SQL}, means AS (SELECT p, avg(v) AS m FROM cells GROUP BY 1),
middle AS (SELECT list(m ORDER BY p) AS m FROM means),
within_c AS (SELECT sum({DISTANCE.format('x', 'c')}) AS w, count(*) AS n FROM pts JOIN centers ON pts.cluster_id = centers.cluster_id),
sizes AS (SELECT cluster_id, count(*) AS n FROM pts GROUP BY 1),
between_c AS (SELECT sum(n * {DISTANCE.format('c', 'm')}) AS b, count(*) AS k FROM sizes JOIN centers ON sizes.cluster_id = centers.cluster_id, middle)
SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM within_c, between_c""")
def calinski_harabasz(spark, sf_dir):
    return rounded(scoring.calinski_harabasz(points(spark, sf_dir)))


@check("cluster_balance", """WITH s AS (SELECT count(*) AS n FROM embeddings GROUP BY label)
SELECT min(n) AS min_cluster_size, max(n) AS max_cluster_size, round(stddev_pop(n), 6) AS cluster_size_std,
  round(stddev_pop(n) / avg(n), 6) AS cluster_size_cv FROM s""")
def cluster_balance(spark, sf_dir):
    return rounded(scoring.cluster_balance(points(spark, sf_dir)))


@check("gate_enough_clusters", """SELECT 'enough_clusters' AS "check", CAST(greatest(2 - count(DISTINCT label), 0) AS BIGINT) AS failures,
  count(DISTINCT label) >= 2 AS passed FROM embeddings""")
def gate_enough_clusters(spark, sf_dir):
    return gates.enough_clusters(points(spark, sf_dir))


@check("gate_features", """WITH c AS (SELECT 'rows_match' AS "check", count(*) FILTER (WHERE vec_id IS NULL) AS failures FROM embeddings
  UNION ALL SELECT 'width', count(*) FILTER (WHERE len(embedding) <> 64) FROM embeddings
  UNION ALL SELECT 'finite', count(*) FILTER (WHERE len(list_filter(embedding, lambda v: NOT isfinite(v))) > 0) FROM embeddings)
SELECT "check", failures, failures = 0 AS passed FROM c""")
def gate_features(spark, sf_dir):
    rows = points(spark, sf_dir)
    return gates.features_sound(rows, rows.select("id"), 64)


@check("features_written_and_read", "SELECT vec_id AS id, label AS cluster_id, len(embedding) AS width FROM embeddings")
def features_written_and_read(spark, sf_dir):
    rows, path = points(spark, sf_dir), scratch(spark, "features")
    sources.write_features(rows.select("id", "features"), f"{path}/x")
    sources.write_features(rows.select("id", "cluster_id"), f"{path}/meta")
    read = sources.load_feature_set(spark, f"{path}/x", f"{path}/meta", 64)
    return read.select("id", "cluster_id", F.size("features").cast("long").alias("width"))


@check("feature_set_versions", """SELECT vec_id AS id, label AS cluster_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first, 2::BIGINT AS version FROM embeddings
UNION ALL SELECT vec_id, label, round(CAST(embedding[2] AS DOUBLE), 6), 1::BIGINT FROM embeddings WHERE label > 4""")
def feature_set_versions(spark, sf_dir):
    """Two versions of a bucketed feature set; the older one holds other rows and vectors."""
    rows, path = points(spark, sf_dir), scratch(spark, "versions")
    turned = rows.where("cluster_id > 4").withColumn("features", F.reverse("features"))
    sources.write_feature_set(turned.select("id", "features"), turned.select("id", "cluster_id"), path)
    sources.write_feature_set(rows.select("id", "features"), rows.select("id", "cluster_id"), path)
    older, newer = sources.read_feature_set(spark, path, 64, version=1), sources.read_feature_set(spark, path, 64)
    picked = [
        df.select("id", "cluster_id", F.get("features", F.lit(at)).alias("first"), F.lit(n).cast("long").alias("version"))
        for df, at, n in ((newer, 0, 2), (older, 62, 1))
    ]
    return rounded(picked[0].unionByName(picked[1]))


@check("model_round_trip", f"""{VOCAB_SQL}, {POINTS_SQL.removeprefix('WITH ').rstrip().rstrip(',')},
means AS (SELECT cluster_id, avg(x[1]) AS value FROM pts GROUP BY 1)
SELECT 'vocab' AS part, term_idx AS place, term, round(idf, 6) AS value FROM vocab
UNION ALL SELECT 'centers', row_number() OVER (ORDER BY cluster_id) - 1, NULL, round(value, 6) FROM means""")
def model_round_trip(spark, sf_dir):
    """Vocabulary and centers saved as one version over an older one and loaded again."""
    tfidf, path = X.TfidfModel.fit(tokenized(spark, sf_dir)), scratch(spark, "models")
    _, centers, _ = clustering.collect_centers(clustering.cluster_means(points(spark, sf_dir)), "cluster_id")
    factor = np.ones((len(tfidf.terms), 1))
    for each in (centers[:1], centers):
        features = train_plan.FeatureModel(tfidf, factor, 1, 3)
        train_plan.save_models(spark, path, features, clustering.ClusterModel(each))
    loaded, model = train_plan.load_models(spark, path)
    vocab = loaded.tfidf.table(spark).select(F.lit("vocab").alias("part"), F.col("term_idx").alias("place"), "term", F.col("idf").alias("value"))
    places = model.table(spark).select(
        F.lit("centers"), "cluster_id", F.lit(None).cast("string"), F.get("center", F.lit(0))
    )
    return longs(rounded(vocab.union(places)), "place")


# A table of model scores, one per return flag, line status and line number.
METRICS = {
    "silhouette": "avg(l_discount)", "davies_bouldin": "avg(l_tax) * 10",
    "calinski_harabasz": "avg(l_extendedprice)", "cluster_size_cv": "stddev_pop(l_quantity) / avg(l_quantity)",
}
METRICS_SQL = f"""m AS (SELECT l_returnflag AS model, l_linestatus AS feature_space, l_linenumber AS k,
  {', '.join(f'round({e}, 6) AS {n}' for n, e in METRICS.items())} FROM lineitem GROUP BY 1, 2, 3),
ranked AS (SELECT *, rank() OVER (ORDER BY silhouette DESC) AS rank_silhouette, rank() OVER (ORDER BY davies_bouldin) AS rank_davies_bouldin,
  rank() OVER (ORDER BY calinski_harabasz DESC) AS rank_calinski_harabasz, rank() OVER (ORDER BY cluster_size_cv) AS rank_cluster_balance FROM m),
total AS (SELECT *, CAST(rank_silhouette + rank_davies_bouldin + rank_calinski_harabasz AS DOUBLE) + 0.5 * rank_cluster_balance AS total_rank FROM ranked)"""


def metrics(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("feature_space"), F.col("l_linenumber").alias("k")
    )
    return rows.agg(*[F.expr(f"round({e}, 6)").alias(n) for n, e in METRICS.items()])


_RANKS = ("rank_silhouette", "rank_davies_bouldin", "rank_calinski_harabasz", "rank_cluster_balance")


@check("rank_models", f"WITH {METRICS_SQL} SELECT * FROM total")
def rank_models(spark, sf_dir):
    return longs(scoring.rank_models(metrics(spark, sf_dir)), *_RANKS)


@check("pick_best", f"WITH {METRICS_SQL} SELECT * FROM total ORDER BY total_rank, silhouette DESC, davies_bouldin, calinski_harabasz DESC LIMIT 1")
def pick_best(spark, sf_dir):
    return longs(scoring.pick_best(scoring.rank_models(metrics(spark, sf_dir))), *_RANKS)


@check("pick_best_of_finished", f"""WITH {METRICS_SQL} SELECT model, feature_space, k, total_rank FROM total
WHERE model <> 'N' ORDER BY total_rank, silhouette DESC LIMIT 1""")
def pick_best_of_finished(spark, sf_dir):
    status = F.when(F.col("model") == "N", "failed").otherwise(F.lit("ok"))
    ranked = scoring.rank_models(metrics(spark, sf_dir)).withColumn("status", status)
    return scoring.pick_best(ranked, "status").select("model", "feature_space", "k", "total_rank")


@check("compare_to_baseline", f"""WITH {METRICS_SQL}, t AS (SELECT avg(silhouette) AS s, avg(davies_bouldin) AS d, avg(calinski_harabasz) AS c FROM m WHERE model = 'R'),
b AS (SELECT avg(silhouette) AS s, avg(davies_bouldin) AS d, avg(calinski_harabasz) AS c FROM m WHERE model <> 'R')
SELECT 'silhouette' AS metric, round(b.s, 4) AS baseline, round(t.s, 4) AS tuned, round(t.s - b.s, 4) AS gain FROM t, b
UNION ALL SELECT 'davies_bouldin', round(b.d, 4), round(t.d, 4), round(b.d - t.d, 4) FROM t, b
UNION ALL SELECT 'calinski_harabasz', round(b.c, 4), round(t.c, 4), round(t.c - b.c, 4) FROM t, b""")
def compare_to_baseline(spark, sf_dir):
    rows = metrics(spark, sf_dir)
    means = [F.avg(c).alias(c) for c in ("silhouette", "davies_bouldin", "calinski_harabasz")]
    tuned, baseline = rows.where("model = 'R'").agg(*means), rows.where("model <> 'R'").agg(*means)
    return rounded(scoring.compare_to_baseline(tuned, baseline), digits=4)


@check("pivot_metrics", f"""WITH {METRICS_SQL} SELECT k, {', '.join(f"max(silhouette) FILTER (WHERE model = '{m}' AND feature_space = '{s}') AS {m}_{s}" for m in 'ANR' for s in 'FO')} FROM m GROUP BY 1""")
def pivot_metrics(spark, sf_dir):
    return profiling.pivot_metrics(metrics(spark, sf_dir), "silhouette", [(m, s) for m in "ANR" for s in "FO"])


# Customers with their market segment as the cluster.
CLUSTER_COLUMNS = ("job_title", "job_industry", "experience_level", "location")
CLUSTERED = {
    "id": "c_custkey", "cluster_id": "CAST(length(c_mktsegment) AS INT)", "salary_expected_million_vnd": "c_acctbal",
    "job_title": "CASE WHEN c_custkey % 13 = 0 THEN '  ' ELSE concat(n_name, ' ') END", "job_industry": "c_mktsegment",
    "experience_level": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE r_name END", "location": "r_name",
}
CLUSTERED_SQL = f"""clustered AS (SELECT {', '.join(f'{e} AS {n}' for n, e in CLUSTERED.items())} FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
named AS (SELECT id, cluster_id, salary_expected_million_vnd, {', '.join(f"coalesce(nullif(trim({c}), ''), 'unknown') AS {c}" for c in CLUSTER_COLUMNS)} FROM clustered),
vals AS ({' UNION ALL '.join(f"SELECT cluster_id, '{c}' AS col, {c} AS value, count(*) AS n FROM named GROUP BY ALL" for c in CLUSTER_COLUMNS)}),
rk AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, col ORDER BY n DESC, value) AS r FROM vals),
tops AS (SELECT cluster_id, {', '.join(f"string_agg(concat(value, ' (', n, ')'), '; ' ORDER BY r) FILTER (WHERE col = '{c}' AND r <= 5) AS top_{c}" for c in CLUSTER_COLUMNS)} FROM rk GROUP BY 1),
firsts AS (SELECT cluster_id, {', '.join(f"max(value) FILTER (WHERE col = '{c}' AND r = 1) AS {c}" for c in CLUSTER_COLUMNS)} FROM rk GROUP BY 1),
sugg AS (SELECT cluster_id, concat(job_industry, ' - ', job_title) AS suggested_cluster_label FROM firsts),
profiles AS (SELECT clustered.cluster_id, count(*) AS cluster_size, round(count(*) / (SELECT count(*) FROM clustered), 6) AS cluster_ratio,
  round(avg(salary_expected_million_vnd), 4) AS salary_mean, round(quantile_cont(salary_expected_million_vnd, 0.5), 4) AS salary_median,
  round(min(salary_expected_million_vnd), 4) AS salary_min, round(max(salary_expected_million_vnd), 4) AS salary_max FROM clustered GROUP BY 1)"""


def clustered(spark, sf_dir):
    rows = (
        load(spark, sf_dir, "customer")
        .join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.selectExpr(*[f"{e} AS {n}" for n, e in CLUSTERED.items()])


def profiled(spark, sf_dir):
    return P.cluster_profiles(clustered(spark, sf_dir), columns=CLUSTER_COLUMNS)


@check("cluster_profiles", f"""WITH {CLUSTERED_SQL} SELECT profiles.*, tops.* EXCLUDE (cluster_id), '' AS top_keywords, suggested_cluster_label
FROM profiles JOIN tops USING (cluster_id) JOIN sugg USING (cluster_id)""")
def cluster_profiles(spark, sf_dir):
    rows = rounded(profiled(spark, sf_dir), "salary_mean", "salary_median", "salary_min", "salary_max", digits=4)
    return rounded(rows, "cluster_ratio")


@check("top_values_text", f"WITH {CLUSTERED_SQL} SELECT * FROM tops")
def top_values_text(spark, sf_dir):
    return P.top_values_text(clustered(spark, sf_dir), "cluster_id", CLUSTER_COLUMNS)


@check("suggest_label", f"WITH {CLUSTERED_SQL} SELECT * FROM sugg")
def suggest_label(spark, sf_dir):
    return P.suggest_label(P.top_values_by_group(clustered(spark, sf_dir), "cluster_id", CLUSTER_COLUMNS))


_TEMPLATE_SQL = f"""{CLUSTERED_SQL}, template AS (SELECT cluster_id, cluster_size, top_job_industry, top_job_title, salary_mean,
  suggested_cluster_label, CASE WHEN cluster_size > 400 THEN concat('by hand ', cluster_size) ELSE '' END AS manual_cluster_label
  FROM profiles JOIN tops USING (cluster_id) JOIN sugg USING (cluster_id))"""


def template(spark, sf_dir):
    """Labels given by hand to the large clusters only."""
    rows = profiled(spark, sf_dir)
    earlier = rows.where("cluster_size > 400").select(
        "cluster_id", F.concat(F.lit("by hand "), "cluster_size").alias("manual_cluster_label")
    )
    return P.label_template(rows, earlier)


@check("label_template", f"WITH {_TEMPLATE_SQL} SELECT * FROM template")
def label_template(spark, sf_dir):
    return rounded(template(spark, sf_dir), digits=4)


@check("attach_labels", f"""WITH {_TEMPLATE_SQL} SELECT clustered.id, clustered.cluster_id,
  CASE WHEN trim(manual_cluster_label) <> '' THEN manual_cluster_label ELSE suggested_cluster_label END AS cluster_label
FROM clustered LEFT JOIN template ON clustered.cluster_id = template.cluster_id""")
def attach_labels(spark, sf_dir):
    rows = clustered(spark, sf_dir).select("id", "cluster_id")
    return P.attach_labels(rows, template(spark, sf_dir))


_MAP = {8: "Building", 9: "Household", 10: "Automobile"}
_MAP_SQL = "CASE cluster_id " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _MAP.items()) + " END"


@check("apply_label_map", f"WITH {CLUSTERED_SQL} SELECT id, cluster_id, {_MAP_SQL} AS cluster_label FROM clustered")
def apply_label_map(spark, sf_dir):
    return P.apply_label_map(clustered(spark, sf_dir).select("id", "cluster_id"), P.label_map(spark, _MAP))


@check("gate_labels", f"""WITH {CLUSTERED_SQL}, c AS (SELECT 'cluster_known' AS "check", count(*) FILTER (WHERE {_MAP_SQL} IS NULL) AS failures FROM clustered
  UNION ALL SELECT 'label_present', count(*) FILTER (WHERE {_MAP_SQL} IS NULL) FROM clustered)
SELECT "check", failures, failures = 0 AS passed FROM c""")
def gate_labels(spark, sf_dir):
    named = P.label_map(spark, _MAP)
    return gates.clusters_labelled(P.apply_label_map(clustered(spark, sf_dir), named), named)


@check("demo_rows", f"""WITH {CLUSTERED_SQL}, d AS (SELECT * FROM clustered ORDER BY md5(concat('42:', id)), id LIMIT 10)
SELECT id, job_title, salary_expected_million_vnd, job_industry, experience_level, location, cluster_id FROM d""")
def demo_rows(spark, sf_dir):
    return P.demo_rows(clustered(spark, sf_dir))


@check("top_keywords", f"""{WEIGHTS_SQL}, s AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1),
m AS (SELECT lang, term, sum(weight) / any_value(size) AS mean FROM weights JOIN documents ON id = doc_id JOIN s USING (lang) GROUP BY 1, 2),
r AS (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY round(mean, 9) DESC, term) AS rk FROM m WHERE mean > 0)
SELECT lang, string_agg(term, '; ' ORDER BY rk) AS top_keywords FROM r WHERE rk <= 10 GROUP BY 1""")
def top_keywords(spark, sf_dir):
    model, weights = fitted(spark, sf_dir)
    return P.top_keywords(weights, None, model.table(spark), by="lang")


@check("category_share_by_cluster", f"""WITH {CLUSTERED_SQL}, top AS (SELECT r_name AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10),
s AS (SELECT cluster_id, count(*) AS size FROM clustered GROUP BY 1)
SELECT s.cluster_id, top.value, round(count(c.id) / any_value(s.size), 6) AS ratio FROM s CROSS JOIN top
LEFT JOIN clustered c ON c.cluster_id = s.cluster_id AND c.location = top.value GROUP BY 1, 2""")
def category_share_by_cluster(spark, sf_dir):
    return rounded(profiling.category_share_by_group(clustered(spark, sf_dir), "cluster_id", "location"))


# Iterative fits: no SQL gives the same centers; the rows are the centers' summaries.
def _described(model: clustering.ClusterModel, rows):
    sizes = clustering.assign_cluster(rows, model.centers).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumns({
        "model": F.lit(model.model), "inertia": F.round(F.lit(model.inertia), 4),
        "fit_rows": F.lit(model.fit_rows), "fit_note": F.lit(model.fit_note),
    })


@check("kmeans_fit")
def kmeans_fit(spark, sf_dir):
    rows = points(spark, sf_dir).drop("cluster_id")
    return _described(clustering.renumbered(clustering.kmeans_fit(rows, 10, restarts=3, max_iter=50), rows), rows)


@check("minibatch_kmeans_fit")
def minibatch_kmeans_fit(spark, sf_dir):
    rows = points(spark, sf_dir).drop("cluster_id")
    return _described(clustering.minibatch_kmeans_fit(rows, 10, 256, max_batches=20), rows)


@check("fit_on_sample")
def fit_on_sample(spark, sf_dir):
    rows = points(spark, sf_dir).drop("cluster_id")
    model = clustering.fit_on_sample(rows, lambda df: clustering.kmeans_fit(df, 5, 2, 20), 400)
    return _described(model, rows)


@check("run_grid")
def run_grid(spark, sf_dir):
    rows = points(spark, sf_dir).drop("cluster_id")
    specs = clustering.grid_specs(None, 1, 20, 256, 42, 10)
    spaces = {"svd": rows, "svd10_l2": X.low_dimensional(rows, 10)}
    table, _ = clustering.run_grid(spaces, (3, 4), specs, scoring.evaluate_clusters)
    return rounded(scoring.rank_models(table).drop("train_time_sec"), digits=4)


_SCORES_SQL = [SQL[name] for name in ("silhouette", "davies_bouldin", "calinski_harabasz", "cluster_balance")]


@check("model_info", f"""SELECT round(silhouette, 4) AS silhouette, round(davies_bouldin, 4) AS davies_bouldin,
  round(calinski_harabasz, 4) AS calinski_harabasz, min_cluster_size, max_cluster_size,
  round(cluster_size_std, 4) AS cluster_size_std, round(cluster_size_cv, 4) AS cluster_size_cv,
  (SELECT least(count(*), 10000) FROM embeddings) AS eval_rows, 'KMeans' AS model_name, 'svd' AS feature_space
FROM {', '.join(f'({sql}) AS s{i}' for i, sql in enumerate(_SCORES_SQL))}""")
def model_info(spark, sf_dir):
    scores = scoring.evaluate_clusters(points(spark, sf_dir))
    return rounded(P.model_info(scores, {"model_name": "KMeans", "feature_space": "svd"}), digits=4)


# Customers around five points that lie far apart, so that SQL knows the clusters.
PLANTED = {"g": "c_nationkey % 5", "x": "CAST(1000 * (c_nationkey % 5) AS DOUBLE)",
           "y": "CAST(500 * (c_nationkey * 2 % 5) AS DOUBLE)", "z": "CAST(c_acctbal AS DOUBLE) / 1000"}
PLANTED_SQL = f"""planted AS (SELECT {', '.join(f'{e} AS {n}' for n, e in PLANTED.items())} FROM customer),
means AS (SELECT g, x, y, avg(z) AS middle, count(*) AS size FROM planted GROUP BY 1, 2, 3)"""


def planted(spark, sf_dir):
    return load(spark, sf_dir, "customer").selectExpr("c_custkey AS id", f"array({', '.join(PLANTED[c] for c in 'xyz')}) AS features")


def _placed(model: clustering.ClusterModel, rows):
    """Size and first two coordinates of each center, and what the model says of its fit."""
    near = rows.sparkSession.createDataFrame(
        [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.centers)], "cluster_id int, x double, y double")
    described = _described(model, rows).join(F.broadcast(near), "cluster_id").drop("cluster_id", "inertia")
    return rounded(described.withColumn("fit_rows", F.col("fit_rows").cast("long")), digits=3)


@check("kmeans_planted", f"""WITH {PLANTED_SQL}, total AS (SELECT sum((z - middle) * (z - middle)) AS inertia, count(*) AS n FROM planted JOIN means USING (g))
SELECT x, y, round(middle, 4) AS z, size, round(inertia, 2) AS inertia, n AS fit_rows FROM means, total""")
def kmeans_planted(spark, sf_dir):
    rows = planted(spark, sf_dir)
    model = clustering.kmeans_fit(rows, 5, restarts=5, max_iter=50)
    means = clustering.cluster_means(clustering.assign_cluster(rows, model.centers))
    cells = means.select(*[F.round(F.col("center")[i], 4).alias(c) for i, c in enumerate("xyz")], "size")
    return cells.withColumns({"inertia": F.round(F.lit(model.inertia), 2), "fit_rows": F.lit(model.fit_rows).cast("long")})


@check("minibatch_planted", f"""WITH {PLANTED_SQL} SELECT x, y, size, 'MiniBatchKMeans' AS model, 'fit_full_train' AS fit_note,
  (SELECT count(*) FROM customer) AS fit_rows FROM means""")
def minibatch_planted(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return _placed(clustering.minibatch_kmeans_fit(rows, 5, 128, max_batches=20, restarts=5), rows)


@check("sample_fit_planted", f"""WITH {PLANTED_SQL} SELECT x, y, size, 'KMeans' AS model, 'fit_on_sample_100' AS fit_note, CAST(100 AS BIGINT) AS fit_rows FROM means""")
def sample_fit_planted(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return _placed(clustering.fit_on_sample(rows, lambda df: clustering.kmeans_fit(df, 5, 5, 20), 100), rows)


@check("train_and_score_flow")
def train_and_score_flow(spark, sf_dir):
    """Train on one part of the postings and give the other part its clusters."""
    rows = score_plan.prepare_new(postings(spark, sf_dir)).withColumn(
        "split", F.when(F.col("job_type") == "f", "test").otherwise(F.lit("train")))
    rows = stage(rows, "prepared")
    trained = train_plan.train(rows.where("split = 'train'"), SMALL)
    found = score_plan.assign_new(rows.where("split = 'test'"), trained.features, trained.model.centers)
    labels = trained.profiles.select("cluster_id", F.col("final_cluster_label").alias("cluster_label"))
    return P.apply_label_map(found, labels).groupBy("cluster_id", "cluster_label").count()
