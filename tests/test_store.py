import pytest
from pyspark.sql import functions as F

from jobmine.sources import store, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pair(spark, low, high):
    rows = spark.range(low, high)
    return rows.select("id", F.array(F.col("id") * 1.0).alias("features")), rows.select("id", (F.col("id") * 2).alias("twice"))


def test_versions_and_counts(spark, tmp_path):
    path = str(tmp_path / "s")
    assert store.versions(spark, path) == [] and store.row_counts(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, path)
    assert store.write_version({"a": spark.range(3), "b": spark.range(0)}, path) == 1
    assert store.write_version({"a": spark.range(5)}, path) == 2
    assert store.versions(spark, path) == [1, 2]
    assert {tuple(r) for r in store.row_counts(spark, path).collect()} == {(1, "a", 3), (1, "b", 0), (2, "a", 5)}
    assert store.read_version(spark, path)["a"].count() == 5
    old = store.read_version(spark, path, 1)
    assert old["a"].count() == 3 and old["b"].count() == 0 and old["b"].columns == ["id"]
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, path, 9)


def test_a_crash_between_tables_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "s")
    store.write_version({"a": spark.range(3), "b": spark.range(3)}, path)
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.write_version({"a": spark.range(4), "b": broken}, path)
    assert store.versions(spark, path) == [1]
    assert {n: t.count() for n, t in store.read_version(spark, path).items()} == {"a": 3, "b": 3}
    assert store.write_version({"a": spark.range(6), "b": spark.range(6)}, path) == 2
    assert {n: t.count() for n, t in store.read_version(spark, path).items()} == {"a": 6, "b": 6}


def test_two_writers_of_one_number_are_not_mixed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    monkeypatch.setattr(store, "versions", lambda *a: [])
    for n in (3, 4):
        assert store.write_version({"a": spark.range(n), "b": spark.range(n)}, path) == 1
    found = store.read_version(spark, path)
    assert found["a"].count() == found["b"].count() in (3, 4)


def test_feature_sets_join_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "it's here")
    tables.write_feature_set(*pair(spark, 0, 40), path)
    assert tables.write_feature_set(*pair(spark, 0, 100), path, buckets=5) == 2
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.read_feature_set(spark, path, 1)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert {(r["id"], r["features"][0], r["twice"]) for r in joined.collect()} == {(i, i * 1.0, i * 2) for i in range(100)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert tables.read_feature_set(spark, path, 1, version=1).count() == 40
    store.forget(spark, path)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("store_")]
    assert tables.read_feature_set(spark, path, 1).count() == 100
    store.forget(spark, path)


def test_feature_set_with_other_ids_is_refused(spark, tmp_path):
    features, _ = pair(spark, 0, 5)
    tables.write_feature_set(features, pair(spark, 0, 4)[1], str(tmp_path / "s"))
    with pytest.raises(AssertionError, match="rows_match"):
        tables.read_feature_set(spark, str(tmp_path / "s"), 1)
    store.forget(spark, str(tmp_path / "s"))
