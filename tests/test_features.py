import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmine.config import Settings
from jobmine.operators import text_features as X

TINY = Settings(min_df=1, max_df=1.0, vocabulary_size=10, ngram_max=1)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, "aa bb aa"), (2, "bb cc"), (3, "dd"), (4, "x"), (5, None)]
    return spark.createDataFrame(rows, "id long, text string")


def test_stop_tokens():
    found = X.stop_tokens(["cong viec", "Da", "a", "da"])
    assert found == ["cong", "da", "viec"]
    assert len(X.stop_tokens()) == len(set(X.stop_tokens())) and "bao" in X.stop_tokens()


def test_stop_words_go_before_ngrams_are_made(spark):
    df = spark.createDataFrame([("Làm việc các nhóm lớn, A1 b _x2",)], "t string")
    grams = X.tokenize_ngrams(df, "t", "g", 1, 3, ["các"]).first()["g"]
    words = ["làm", "việc", "nhóm", "lớn", "a1", "_x2"]
    expected = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert sorted(grams) == sorted(expected)
    short = spark.createDataFrame([("ab",), ("",), (None,)], "t string")
    assert sorted(len(r["g"]) for r in X.tokenize_ngrams(short, "t", "g", 1, 3).collect()) == [0, 0, 1]
    folded = X.tokenize_ngrams(df, "t", "g", 1, 1, ["cac"], fold=True).first()["g"]
    assert "các" not in folded


def test_tiny_corpus_by_hand(spark, corpus):
    rows = X.tokenize_ngrams(corpus, "text", "grams", 1, 1)
    vocabulary = {r["term"]: r.asDict() for r in X.select_vocabulary(rows, settings=TINY).collect()}
    assert {t: (v["tf"], v["df"], v["term_idx"]) for t, v in vocabulary.items()} == {
        "aa": (2, 1, 0), "bb": (2, 2, 1), "cc": (1, 1, 2), "dd": (1, 1, 3)}
    idf = {t: math.log(6 / (1 + v["df"])) + 1 for t, v in vocabulary.items()}
    assert all(vocabulary[t]["idf"] == pytest.approx(i) for t, i in idf.items())
    model = X.TfidfModel.fit(rows, settings=TINY)
    weights = {r["id"]: dict(zip(r["term_idx"], r["weight"], strict=True)) for r in X.tfidf_transform(rows, model).collect()}
    a, b = (1 + math.log(2)) * idf["aa"], idf["bb"]
    assert weights[1] == pytest.approx({0: a / math.hypot(a, b), 1: b / math.hypot(a, b)})
    assert weights[3] == {3: 1.0} and weights[4] == {} and weights[5] == {}


def test_vocabulary_limits(spark, corpus):
    rows = X.tokenize_ngrams(corpus, "text", "grams", 1, 1)
    rare = X.select_vocabulary(rows, settings=Settings(min_df=2, max_df=1.0)).collect()
    assert [r["term"] for r in rare] == ["bb"]
    common = X.select_vocabulary(rows, settings=Settings(min_df=1, max_df=0.2)).collect()
    assert sorted(r["term"] for r in common) == ["aa", "cc", "dd"]
    top = X.select_vocabulary(rows, settings=Settings(min_df=1, max_df=1.0, vocabulary_size=3)).collect()
    assert sorted(r["term"] for r in top) == ["aa", "bb", "cc"]


@pytest.mark.parametrize("low", [1, 2])
def test_vocabulary_level_by_level(spark, low, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 25), p=np.arange(12, 0, -1) / 78)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, "", "solo"]], "t string")
    rows = X.tokenize_ngrams(df, "t", "grams", low, 3)
    settings = Settings(min_df=7, max_df=0.5, vocabulary_size=10_000)
    counted = {}
    for row in rows.collect():
        for term in set(row["grams"]):
            tf, df_ = counted.get(term, (0, 0))
            counted[term] = tf + row["grams"].count(term), df_ + 1
    wanted = {t: c for t, c in counted.items() if 7 <= c[1] <= 0.5 * 303}
    assert {t.count(" ") for t in wanted} == {0, 1, 2} - set(range(low - 1))
    for bits in (16, 1):  # a filter that lets much through by mistake gives the same
        monkeypatch.setattr("jobmine.operators.suspects.BITS_PER_KEY", bits)
        monkeypatch.setattr("jobmine.operators.suspects.MIN_WORDS", 1)
        found = {r["term"]: (r["tf"], r["df"]) for r in X.select_vocabulary(rows, settings=settings).collect()}
        assert found == wanted
    longer = Settings(min_df=7, max_df=0.5, ngram_max=2)  # longer n-grams than the setting names
    found = {r["term"]: (r["tf"], r["df"]) for r in X.select_vocabulary(rows, settings=longer).collect()}
    assert found == wanted


def test_empty_vocabulary(spark, corpus):
    rows = X.tokenize_ngrams(corpus, "text", "grams", 1, 1)
    model = X.TfidfModel.fit(rows, settings=Settings(min_df=99))
    assert X.weights_long(X.tfidf_transform(rows, model)).count() == 0


def test_model_round_trip(spark, corpus, tmp_path):
    model = X.TfidfModel.fit(X.tokenize_ngrams(corpus, "text", "grams", 1, 1), settings=TINY)
    model.table(spark).write.parquet(str(tmp_path / "vocab"))
    assert X.TfidfModel.from_table(spark.read.parquet(str(tmp_path / "vocab"))) == model


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 40))
    matrix[np.abs(matrix) < 2] = 0.0
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for i, r in enumerate(matrix)]
    return matrix, spark.createDataFrame(rows, "id long, term_idx array<int>, weight array<double>").repartition(3)


def test_svd_equals_dense_svd(dense):
    matrix, weights = dense
    factor = X.svd_fit(weights, 40, 60, 6, passes=12)
    _, values, right = np.linalg.svd(matrix, full_matrices=False)
    assert np.linalg.norm(matrix @ factor, axis=0) == pytest.approx(values[:6], rel=1e-4)
    assert np.abs((factor * right[:6].T).sum(axis=0)) == pytest.approx(np.ones(6), abs=1e-3)
    assert (factor[np.abs(factor).argmax(axis=0), np.arange(6)] > 0).all()
    projected = {r["id"]: r["features"] for r in X.svd_transform(weights, factor).collect()}
    assert np.array([projected[i] for i in range(60)]) == pytest.approx(matrix @ factor)


def test_svd_does_not_depend_on_chunks_or_partitions(dense, monkeypatch):
    _, weights = dense
    first = X.svd_fit(weights, 40, 60, 3)
    monkeypatch.setattr(X, "_CHUNK", 7)
    monkeypatch.setattr(X, "_BLOCK", 16)
    assert X.svd_fit(weights.coalesce(1), 40, 60, 3) == pytest.approx(first, abs=1e-8)


def test_svd_in_panels_and_a_tree(dense, monkeypatch):
    matrix, weights = dense
    first = X.svd_fit(weights, 40, 60, 4, passes=12)
    monkeypatch.setattr(X, "_BLOCK", 4)
    monkeypatch.setattr(X, "_FAN", 2)
    monkeypatch.setattr(X, "PANEL_BYTES", 40 * 8 * 5)
    split = X.svd_fit(weights, 40, 60, 4, passes=12)
    assert split == pytest.approx(first, abs=1e-8)
    assert split.T @ split == pytest.approx(np.eye(4), abs=1e-10)


def test_panels_bound_what_a_task_holds(dense, monkeypatch):
    seen = []
    inner = X._gram_times
    monkeypatch.setattr(X, "PANEL_BYTES", 40 * 8 * 3)
    monkeypatch.setattr(X, "_gram_times", lambda w, panels: seen.extend(panels) or inner(w, panels))
    X.svd_fit(dense[1], 40, 60, 5, passes=1)
    assert sum(p.shape[1] for p in seen) == 2 * 15 and max(p.nbytes for p in seen) <= 40 * 8 * 3


def test_svd_of_low_rank_and_of_nothing(spark, dense):
    rows = [(i, [2 * (i % 2), 2 * (i % 2) + 1], [3.0, 4.0 * (1 + i % 2)]) for i in range(20)]
    schema = "id long, term_idx array<int>, weight array<double>"
    factor = X.svd_fit(spark.createDataFrame(rows, schema), 9, 20, 4)
    b = math.hypot(3, 8)
    expected = [[0, 0, 3 / b, 8 / b, 0, 0, 0, 0, 0], [0.6, 0.8, 0, 0, 0, 0, 0, 0, 0], [0] * 9, [0] * 9]
    assert factor.T == pytest.approx(np.array(expected))
    for nothing in (dense[1].limit(0), spark.createDataFrame([(1, [], []), (2, None, None)], schema)):
        assert not X.svd_fit(nothing, 9, 20, 4).any()


def test_svd_variance(dense):
    matrix, weights = dense
    factor = X.svd_fit(weights, 40, 60, 4)
    found = X.svd_variance(X.svd_transform(weights, factor), weights).orderBy("component").collect()
    expected = (matrix @ factor).var(axis=0) / matrix.var(axis=0).sum()
    assert [r["explained_variance_ratio"] for r in found] == pytest.approx(list(expected))
    assert found[-1]["cumulative_explained_variance"] == pytest.approx(expected.sum())


def test_factor_size_is_checked(dense):
    with pytest.raises(ValueError, match="too large"):
        X.svd_fit(dense[1], 10_000_000, 10_000_000, 300)


def test_vector_steps(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [5.0])], "id long, features array<double>")
    unit = {r["id"]: list(r["features"]) for r in X.l2_normalize(df).collect()}
    assert unit == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: [1.0]}
    kept = {r["id"]: list(r["features"]) for r in X.drop_first_component(df).collect()}
    assert kept == {1: [4.0], 2: [0.0], 3: [5.0]}


def test_ngram_frequency_on_a_sample(spark):
    df = spark.range(500).select("id", F.lit("aa bb aa").alias("text"))
    found = {r["ngram"]: r["freq"] for r in X.ngram_frequency(df, "text", 1, 2, sample=200).collect()}
    assert found == {"aa": 400, "bb": 200, "aa bb": 200, "bb aa": 200}
