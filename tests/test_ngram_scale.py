from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from jobmine.config import Settings
from jobmine.operators import text_features as X


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def grams_of(text):
    words = (text or "").split()
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_ngrams_are_counted_in_their_row(spark):
    rows = [(1, "aa bb aa"), (2, None), (3, "cc"), (4, "aa bb aa bb")]
    df = X.tokenize_ngrams(spark.createDataFrame(rows, "id long, t string"), "t")
    found = X.ngram_counts(df)
    assert "Exchange" not in plan(found)
    wanted = {(i, g): n for i, t in rows for g, n in Counter(grams_of(t)).items()}
    assert {(r["id"], r["gram"]): r["n"] for r in found.collect()} == wanted


def test_ngrams_of_repeated_and_null_ids_are_added_up(spark):
    rows = [(1, "aa bb"), (1, "aa"), (None, "cc"), (None, "cc dd"), (2, "aa"), (3, "")]
    df = X.tokenize_ngrams(spark.createDataFrame(rows, "id long, t string").repartition(3), "t")
    wanted = Counter()
    for i, t in rows:
        wanted.update((i, g) for g in grams_of(t))
    found = [((r["id"], r["gram"]), r["n"]) for r in X.ngram_counts(df).collect()]
    assert len(found) == len(wanted) and dict(found) == wanted


def test_texts_are_not_cut_for_rows_that_are_only_counted(spark):
    df = spark.createDataFrame([(1, "aa bb")], "id long, t string").repartition(2)
    assert "regexp_extract_all" not in plan(X.tokenize_ngrams(df, "t").agg(F.count(F.lit(1))))


@pytest.mark.parametrize("held", [2, 1 << 22])
def test_only_parts_as_common_as_the_last_term_are_looked_at(spark, held, monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(40)], 30, p=np.arange(40, 0, -1) / 820)) for _ in range(200)]
    df = X.tokenize_ngrams(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3), "t", "grams")
    tf, rows = Counter(), Counter()
    for t in texts:
        tf.update(grams_of(t))
        rows.update(set(grams_of(t)))
    fit = [g for g in tf if 3 <= rows[g] <= 0.4 * 200]
    seen, inner = [], X._level
    monkeypatch.setattr(X, "_HELD", held)
    monkeypatch.setattr(X, "_level", lambda *a: seen.append(a[3]) or inner(*a))
    found = X.select_vocabulary(df, settings=Settings(min_df=3, max_df=0.4, vocabulary_size=50)).collect()
    wanted = sorted(fit, key=lambda g: (-tf[g], g))[:50]
    assert {r["term"]: (r["tf"], r["df"]) for r in found} == {g: (tf[g], rows[g]) for g in wanted}
    last = sorted((tf[g] for g in fit if g.count(" ") < 2), reverse=True)[49]
    assert len(seen[0]) == sum(g.count(" ") == 1 and tf[g] >= last for g in tf)


def test_commonest_ngrams_with_ties(spark):
    rows = [(i, t) for i, t in enumerate(["aa bb cc aa bb cc", "bb cc dd", "dd ee", None, "x"])]
    df = spark.createDataFrame(rows, "id long, t string")
    for low, high, n in ((1, 3, 7), (2, 3, 4), (3, 3, 2), (1, 1, 20), (2, 2, 0)):
        every = Counter(g for _, t in rows[:3] for g in grams_of(t) if low <= g.count(" ") + 1 <= high)
        wanted = sorted(every.items(), key=lambda x: (-x[1], x[0]))[:n]
        assert [tuple(r) for r in X.ngram_frequency(df, "t", low, high, n).collect()] == wanted


def no_grams(*_):
    raise AssertionError("n-grams were made")


@pytest.mark.parametrize("low, high, settings", [
    (1, 3, Settings(min_df=3, max_df=0.6, vocabulary_size=60)), (1, 3, Settings(min_df=2, max_df=0.9, vocabulary_size=9_000)),
    (2, 3, Settings(min_df=2, max_df=0.9, vocabulary_size=40)), (1, 3, Settings(min_df=2, vocabulary_size=90, ngram_max=2)),
    (1, 4, Settings(min_df=2, max_df=0.9, vocabulary_size=300, ngram_max=4)),
])
def test_terms_are_counted_and_weighed_from_the_words_alone(spark, low, high, settings, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(15)] + ["đà", "𝒳𝒴"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 30), p=np.arange(17, 0, -1) / 153)) for _ in range(90)]
    rows = [(i % 70, t) for i, t in enumerate([*texts, *texts[:9], None, "", "solo"])]
    df = X.tokenize_ngrams(spark.createDataFrame(rows, "id long, t string").repartition(3), "t", "grams", low, high)
    plain = df.select("id", "grams")  # the words are gone, so the n-grams themselves are read
    model = X.TfidfModel.fit(plain, settings=settings)

    def found(of):
        return sorted((r["id"], tuple(r["term_idx"]), tuple(r["weight"])) for r in X.tfidf_transform(of, model).collect())

    wanted = found(plain)
    monkeypatch.setattr(X, "_joined", no_grams)
    monkeypatch.setattr(X, "_PART", 50)
    assert model.terms and X.TfidfModel.fit(df, settings=settings) == model
    assert found(df) == wanted


def test_ngrams_changed_afterwards_are_read_themselves(spark):
    df = X.tokenize_ngrams(spark.createDataFrame([(1, "aa bb"), (2, "aa")], "id long, t string"), "t")
    changed = df.withColumn("grams", F.filter("grams", lambda g: g != "aa"))
    found = X.select_vocabulary(changed, settings=Settings(min_df=1, max_df=1.0)).collect()
    assert sorted(r["term"] for r in found) == ["aa bb", "bb"]


def test_terms_that_no_words_make_are_not_found(spark):
    df = X.tokenize_ngrams(spark.createDataFrame([(1, "aa bb cc dd")], "id long, t string"), "t", "grams", 2, 3)
    model = X.TfidfModel(["", "aa", "aa  bb", "aa bb", "aa bb cc dd", "bb cc dd"], [1.0] * 6)
    found = X.tfidf_transform(df, model).first()
    assert found["term_idx"] == [3, 5] and found["weight"] == pytest.approx([0.5**0.5] * 2)


def test_places_of_numbers_that_share_slots():
    rng = np.random.default_rng(4)
    held = np.unique(rng.integers(-(1 << 62), 1 << 62, 3_000))
    places, asked = X._Places(held), np.concatenate([held[::-1], held + 1])
    where = {h: i for i, h in enumerate(held.tolist())}
    assert len(places.tables) > 1 and places.find(asked).tolist() == [where.get(a, -1) for a in asked.tolist()]
    assert X._Places(held[:0]).find(asked).tolist() == [-1] * len(asked)


def test_the_passes_of_the_svd_read_packed_weights(spark, monkeypatch):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(50, 12)) * (rng.random((50, 12)) < 0.4)
    rows = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(matrix)]
    rows += [(50, [], []), (51, None, None)]
    weights = spark.createDataFrame(rows, "id long, term_idx array<int>, weight array<double>").repartition(3)
    seen, inner = [], X._gram_times
    monkeypatch.setattr(X, "_PART", 20)
    monkeypatch.setattr(X, "_CELLS", 64)
    monkeypatch.setattr(X, "_gram_times", lambda w, panels: seen.append(w) or inner(w, panels))
    factor = X.svd_fit(weights, 12, 52, 3, passes=15)
    assert all(w.columns == ["sizes", "terms", "values"] for w in seen) and seen[0].count() > 3
    assert np.linalg.norm(matrix @ factor, axis=0) == pytest.approx(np.linalg.svd(matrix)[1][:3], rel=1e-4)


@pytest.mark.parametrize("slots", [8, 64, 1 << 22])
@pytest.mark.parametrize("low, high", [(1, 3), (2, 3), (3, 3), (2, 2)])
def test_terms_that_share_a_slot_are_told_apart(spark, low, high, slots, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(30)], rng.integers(0, 20))) for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "id long, t string").repartition(3)
    every = Counter(g for t in texts for g in grams_of(t) if low <= g.count(" ") + 1 <= high)
    monkeypatch.setattr(X, "_SLOTS", slots)
    monkeypatch.setattr(X, "_PART", 200)
    for n in (3, 40):
        wanted = sorted(every.items(), key=lambda x: (-x[1], x[0]))[:n]
        assert [tuple(r) for r in X.ngram_frequency(df, "t", low, high, n).collect()] == wanted


def test_rare_pairs_are_not_counted_one_by_one(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = ["the same two words " + " ".join(f"r{i}" for i in rng.integers(0, 5_000, 60)) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string").repartition(3)
    counted, inner = [], X._hash_counts
    monkeypatch.setattr(X, "_hash_counts", lambda *a: counted.append(inner(*a)) or counted[-1])
    assert [tuple(r) for r in X.ngram_frequency(df, "t", 2, 2, 3).collect()] == [
        ("same two", 400), ("the same", 400), ("two words", 400)]
    assert 3 <= sum(c.count() for c in counted) < 4_000  # of 20,000 and more


def test_packed_words_do_not_wait_for_a_hundred_rows(spark, monkeypatch):
    df = spark.createDataFrame([("aa bb cc dd " * 9,)] * 60, "t string").coalesce(1)
    monkeypatch.setattr(X, "_PART", 40)
    monkeypatch.setitem(X._GROUPS, "parquet.block.size", 1 << 10)
    rows = X.tokenize_ngrams(df, "t")
    packed, places = X._packed_words(rows, "_grams_words")
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in packed.inputFiles()]
    assert places == 60 * 36 and packed.count() == 60 and max(groups) > 5


def test_weights_are_made_from_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    df = X.tokenize_ngrams(spark.createDataFrame([(1, "aa bb")], "id long, t string"), "t")
    try:
        for given, kept in (("64m", 4 << 20), (str(1 << 20), 1 << 20)):
            spark.conf.set(key, given)
            X.tfidf_transform(df, X.TfidfModel(["aa"], [1.0]))
            assert int(spark.conf.get(key)) == kept
    finally:
        spark.conf.set(key, before)


def test_rough_counts_are_packed_without_loss():
    values = np.random.default_rng(1).integers(0, 1 << 40, 64)
    values[::3] = 0
    assert X._from_planes(X._planes(values), 64).tolist() == values.tolist()


def test_many_parts_are_packed_into_few_files(spark):
    tasks = 4 * spark.sparkContext.defaultParallelism
    df = X.tokenize_ngrams(spark.createDataFrame([("aa bb",)] * 200, "t string").repartition(3 * tasks), "t")
    packed, places = X._packed_words(df, "_grams_words")
    assert places == 400 and 1 < len(packed.inputFiles()) <= tasks


def test_packed_weights_do_not_wait_for_a_hundred_rows(spark, monkeypatch):
    rows = [(i, list(range(40)), np.random.default_rng(i).random(40).tolist()) for i in range(60)]
    weights = spark.createDataFrame(rows, "id long, term_idx array<int>, weight array<double>").coalesce(1)
    monkeypatch.setattr(X, "_PART", 40)
    monkeypatch.setitem(X._GROUPS, "parquet.block.size", 1 << 10)
    packed = X._packed_weights(weights)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in packed.inputFiles()]
    assert packed.count() == 60 and max(f.num_row_groups for f in files) > 5
    assert files[0].row_group(0).column(0).compression == "ZSTD"
