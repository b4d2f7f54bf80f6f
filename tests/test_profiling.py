import math

import pytest
from pyspark.sql import functions as F

from jobmine.operators import profiling, shift


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a", 1.0, None), (2, "a", 2.0, "x"), (3, "b", 3.0, "x"), (4, None, 10.0, None)]
    return spark.createDataFrame(rows, "id long, c string, v double, t string")


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_schema_summary(people):
    for approximate in (False, True):
        found = by(profiling.schema_summary(people, approximate=approximate), "column")
        assert found["c"] == {"column": "c", "dtype": "string", "missing_count": 1, "missing_ratio": 0.25, "n_unique": 2}
        assert found["t"]["missing_count"] == 2 and found["v"]["n_unique"] == 4


def test_missing_summary_is_sorted(people):
    assert [r["column"] for r in profiling.missing_summary(people).collect()] == ["t", "c", "id", "v"]


def test_duplicate_summary_counts_rows_inside_groups(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "a", None), (None, "b", "z"), (None, "c", "z")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    found = by(profiling.duplicate_summary(df, "id", ["x", "y"]), "check")
    assert {k: v["count"] for k, v in found.items()} == {
        "duplicate_id": 4, "duplicate_full_row": 2, "duplicate_near_key": 3}


def test_text_lengths_count_null_as_empty(people):
    found = by(profiling.text_length_summary(people, ["t", "c"]), "column")["t"]
    assert (found["mean_length"], found["median_length"], found["p90_length"], found["max_length"]) == (0.5, 0.5, 1.0, 1)


def test_top_values_break_ties_by_value(people):
    found = [tuple(r) for r in profiling.top_values(people, ["c", "t"], 2).orderBy("column", F.desc("count"), "value").collect()]
    assert found == [("c", "a", 2), ("c", "b", 1), ("t", "unknown", 2), ("t", "x", 2)]


def test_numeric_describe(people):
    found = by(profiling.numeric_describe(people, ["v"]), "column")["v"]
    assert found["p25"] == 1.75 and found["p50"] == 2.5 and found["p1"] == pytest.approx(1.03)
    assert found["count"] == 4 and found["std"] == pytest.approx(4.0824829)


def test_nan_is_null(spark):
    rows = [(1, "train", 1.0, 1.0), (2, "train", 2.0, float("nan")), (3, "test", float("nan"), 2.0), (4, "test", 3.0, None)]
    df = spark.createDataFrame(rows, "id long, split string, v double, w float")
    found = profiling.numeric_describe(df, ["v"]).first()
    assert (found["count"], found["mean"], found["p50"], found["max"]) == (3, 2.0, 2.0, 3.0)
    assert {r["column"]: r["missing_count"] for r in profiling.missing_summary(df).collect()} == {"id": 0, "split": 0, "v": 1, "w": 2}
    assert by(profiling.schema_summary(df), "column")["w"]["missing_count"] == 2
    assert shift.ks_shift(df, ["v"]).first()["test_mean"] == 3.0


def test_histogram_clips(people):
    found = {r["bin"]: r["count"] for r in profiling.histogram_table(people, "v", 4, clip=5.0).collect()}
    assert found == {0: 1, 1: 1, 2: 1, 3: 1}
    flat = people.withColumn("v", F.lit(2.0))
    assert [r["count"] for r in profiling.histogram_table(flat, "v", 4).collect()] == [4]


def test_boxplot_leaves_out_fliers(spark):
    df = spark.createDataFrame([(float(v), "g") for v in (1, 2, 3, 4, 100)], "v double, g string")
    for found in (profiling.boxplot_table(df, "v").first(), profiling.boxplot_table(df, "v", "g").first()):
        assert (found["q1"], found["median"], found["q3"]) == (2.0, 3.0, 4.0)
        assert (found["whisker_low"], found["whisker_high"]) == (1.0, 4.0)


def test_category_share_lists_absent_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "cluster_id int, c string")
    found = {(r["cluster_id"], r["value"]): r["ratio"] for r in profiling.category_share_by_group(df, "cluster_id", "c", 2).collect()}
    assert found == {(1, "a"): 2 / 3, (1, "b"): 1 / 3, (2, "a"): 0.0, (2, "b"): 0.0}


def test_reports_of_fixed_content(spark, people):
    assert profiling.data_dictionary(spark).count() == 15
    assert {r["dtype"]: r["count"] for r in profiling.dtype_counts(people).collect()} == {"bigint": 1, "string": 2, "double": 1}


def test_ks(spark):
    rows = [("train", float(v), 1.0) for v in range(100)] + [("test", float(v), 1.0) for v in range(50, 150)]
    found = by(shift.ks_shift(spark.createDataFrame(rows, "split string, a double, b double"), ["a", "b"]), "column")
    assert found["a"]["ks_statistic"] == pytest.approx(0.5) and found["a"]["train_median"] == 49.5
    rate = 0.5 * math.sqrt(100 * 100 / 200)
    assert found["a"]["ks_pvalue"] == pytest.approx(
        2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * rate * rate) for j in range(1, 101)), rel=1e-6)
    assert (found["b"]["ks_statistic"], found["b"]["ks_pvalue"]) == (0.0, 1.0)


def test_category_shift_and_verdict(spark):
    rows = [("train", "a", 1.0)] * 6 + [("train", None, 2.0)] * 4 + [("test", "a", 1.0)] * 2 + [("test", "z", 2.0)] * 2
    df = spark.createDataFrame(rows, "split string, c string, v double")
    found = by(shift.category_shift(df, ["c"], 12), "value")
    assert found["a"]["abs_diff"] == pytest.approx(0.1)
    assert (found["unknown"]["train_ratio"], found["unknown"]["test_ratio"]) == (0.4, 0.0)
    verdict = by(shift.shift_verdict(shift.ks_shift(df, ["v"]), shift.category_shift(df, ["c"])), "column")
    assert not verdict["v"]["shifted"] and verdict["c"]["shifted"]


def test_clip_and_lump(spark):
    rows = [("train", float(v), "a" if v < 60 else "b" if v < 90 else str(v)) for v in range(101)] + [("test", 500.0, None)]
    df = spark.createDataFrame(rows, "split string, v double, c string")
    clipped = shift.clip_at_train_quantile(df, ["v"], 0.99)
    assert clipped.agg(F.max("v")).first()[0] == 99.0
    lumped = {r["c"]: r["count"] for r in shift.lump_rare(df, "c", 2).groupBy("c").count().collect()}
    assert lumped == {"a": 60, "b": 30, "other": 12}
