import pytest
from pyspark.sql import functions as F

from jobmine.operators import gates, preparation, suspects


def table(spark, values, status="valid"):
    rows = [(i, status, v, v, v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "id long, salary_parse_status string, salary_expected_million_vnd double, salary_min double, salary_max double")


def test_validity(spark):
    rows = [
        (1, "valid", 5.0, 4.0, 6.0), (2, "valid", 0.0, 0.0, 0.0), (3, "ambiguous", 5.0, 5.0, 5.0),
        (4, "valid", None, None, None), (5, "valid", float("inf"), 1.0, 1.0), (6, "valid", 5.0, 6.0, 4.0),
        (7, "valid", float("nan"), 1.0, 1.0),
    ]
    df = spark.createDataFrame(
        rows, "id long, salary_parse_status string, salary_expected_million_vnd double, salary_min double, salary_max double")
    marked = {r["id"]: r["target_is_valid"] for r in preparation.mark_valid(df).collect()}
    assert [k for k, v in marked.items() if v] == [1] and None not in marked.values()
    assert preparation.keep_valid(df, finite=False).count() >= 1


def test_outlier_reasons(spark):
    df = table(spark, [10.0] * 100 + [11.0] * 100 + [0.5, 90.0])
    bounds = preparation.outlier_bounds(df)
    flagged = preparation.flag_outliers(df, bounds)
    reasons = {r["salary_expected_million_vnd"]: r["outlier_reason"] for r in flagged.collect()}
    assert reasons == {
        10.0: "", 11.0: "", 0.5: "below_iqr_lower|below_p1", 90.0: "above_iqr_upper|above_p99"}
    assert preparation.outlier_summary(flagged, bounds).first()["outlier_count"] == 2.0


def test_few_rows_have_no_outliers(spark):
    small = preparation.flag_outliers_iqr(table(spark, [1.0, 1.0, 1.0, 500.0]))
    assert not any(r["is_salary_outlier"] for r in small.collect())
    large = preparation.flag_outliers_iqr(table(spark, [1.0, 1.0, 1.0, 1.0, 500.0]))
    assert sum(r["is_salary_outlier"] for r in large.collect()) == 1


DUPLICATES = [
    (0, 1, "dev", None, "hn", "5 tr"), (1, 1, "dev", None, "hn", "6 tr"), (2, None, "qa", "a", "hn", "5 tr"),
    (3, None, "qa", "b", "hn", "5 tr"), (4, 2, "dev", None, "hn", "5 tr"), (5, 3, "dev", "", "hn", "5 tr"),
]


def duplicates(spark):
    return spark.createDataFrame(
        DUPLICATES, "ord long, id long, job_title string, company_name string, location string, salary string")


def test_near_duplicates_treat_null_as_equal_but_not_as_blank(spark):
    marked = preparation.near_duplicates(duplicates(spark), order="ord")
    assert sorted(r["ord"] for r in marked.where("is_near_duplicate").collect()) == [0, 4]
    assert marked.count() == 6
    assert preparation.near_duplicate_audit(marked).count() == 2


def test_dedup_keeps_the_first_and_merges_null_ids(spark):
    for parts in (1, 5):
        kept = preparation.dedup(duplicates(spark).repartition(parts), ["id"], "ord")
        assert sorted(r["ord"] for r in kept.collect()) == [0, 2, 4, 5]


def test_dedup_of_a_hot_id(spark):
    rows = spark.range(5_000).select("id", F.when(F.col("id") < 3_000, 0).otherwise(F.col("id")).alias("k"))
    kept = preparation.dedup(rows, ["k"], "id")
    assert kept.count() == 2_001 and kept.where("k = 0").first()["id"] == 0


def test_a_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(3_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    held, words = suspects.bloom_filter(keys, "k")
    rows = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("k"))
    found = rows.where(suspects.may_hold(held, words, F.col("k")))
    assert found.where("id < 3000").count() == 3_000 and found.count() < 3_300
    none, few = suspects.bloom_filter(keys.limit(0), "k")
    assert rows.where(suspects.may_hold(none, few, F.col("k"))).count() == 0


def test_a_full_filter_only_makes_more_suspects(spark, monkeypatch):
    monkeypatch.setattr(suspects, "MAX_WORDS", 1)
    monkeypatch.setattr(suspects, "MIN_WORDS", 1)
    rows = spark.range(4_000).select("id", F.when(F.col("id") < 3_000, F.col("id") % 700).otherwise(F.col("id")).alias("k"))
    kept = preparation.dedup(rows, ["k"], "id")
    assert kept.count() == 1_700 and kept.where("id < 700").count() == 700


def test_both_duplicate_marks_in_one_pass(spark):
    for parts in (1, 4):
        marked = preparation.mark_duplicates(duplicates(spark).repartition(parts), "ord")
        assert sorted((r["ord"], r["is_near_duplicate"], r["is_first"]) for r in marked.collect()) == [
            (0, True, True), (1, False, False), (2, False, True), (3, False, False), (4, True, True), (5, False, True)]


def test_whole_rows_are_joined_once_and_only_suspects(spark):
    wide = spark.range(500).selectExpr("id", "id AS ord", "concat('title ', id) AS job_title", "'x' AS company_name",
                                       "'y' AS location", "CAST(id AS string) AS salary", "repeat('long ', 40) AS body")
    marked = preparation.mark_duplicates(wide, "ord")
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # of suspects with their decisions
    assert marked.where("is_near_duplicate OR NOT is_first").count() == 0 and marked.count() == 500


def test_bins_are_right_closed_and_merge_equal_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(None,)], "v double")
    found = {r["v"]: r["stratum"] for r in preparation.stratify_bins(df, "v", 2).collect()}
    assert [found[float(i)] for i in range(1, 11)] == [0] * 5 + [1] * 5 and found[None] is None
    constant = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert {r["stratum"] for r in preparation.stratify_bins(constant, "v", 10).collect()} == {None}


def test_split_without_bins_is_plain(spark):
    df = spark.range(95).withColumn("v", F.lit(1.0))
    split = preparation.stratified_split(preparation.stratify_bins(df, "v"))
    assert split.where("split = 'test'").count() == 10  # rounded up
    assert gates.require(gates.split_ids(split)).count() == 3


def test_union_splits(spark):
    both = preparation.union_splits(spark.range(3), spark.range(2))
    assert {r["split"]: r["count"] for r in both.groupBy("split").count().collect()} == {"train": 3, "test": 2}


def test_gates_raise(spark):
    overlapping = preparation.union_splits(spark.range(3), spark.range(2, 4))
    with pytest.raises(AssertionError, match="ids_disjoint"):
        gates.require(gates.split_ids(overlapping))
    with pytest.raises(AssertionError, match="columns_present"):
        gates.require(gates.columns_present(spark.range(1), ["id", "salary"]))
    with pytest.raises(AssertionError, match="same_schema"):
        gates.require(gates.same_schema(spark.range(1), spark.range(1).withColumn("x", F.lit(1))))
    with pytest.raises(AssertionError, match="salary_positive"):
        gates.require(gates.salaries_valid(table(spark, [0.0, 1.0])))
    with pytest.raises(AssertionError, match="row_total"):
        gates.require(gates.row_count(spark.range(12), 13, "row_total"))
    vectors = spark.createDataFrame([(1, [1.0, float("nan")])], "id long, features array<double>")
    with pytest.raises(AssertionError, match="finite"):
        gates.require(gates.features_sound(vectors, spark.range(1, 2), 2))
    with pytest.raises(AssertionError, match="rows_match"):
        gates.require(gates.features_sound(vectors, spark.range(5), 2))
