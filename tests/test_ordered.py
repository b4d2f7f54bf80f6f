import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmine.operators import ordered, preparation, rows

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(params=["one task", "many tasks"])
def limit(request, monkeypatch):
    if request.param == "many tasks":
        monkeypatch.setattr(ordered, "KEYS_PER_TASK", 40)
    return request.param


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, and one group holds most rows."""
    return spark.range(9_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.round(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7.0, 2)).alias("v"),
        F.when(F.col("id") % 10 == 0, "small").otherwise(F.lit("large")).alias("g"),
    ).persist()


def test_quantile_cases(spark, limit):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    found = ordered.quantiles(df, "v", [0.25, 0.5, 0.75, 0.01]).first()
    assert found["n"] == 4 and list(found["q"]) == pytest.approx([1.75, 2.5, 4.75, 1.03])


def test_quantiles_equal_numpy(skewed, limit):
    values = np.array([r["v"] for r in skewed.collect()])
    found = ordered.quantiles(skewed, "v", SHARES).first()
    assert list(found["q"]) == pytest.approx(list(np.quantile(values, SHARES)))


def test_group_quantiles_equal_numpy(skewed, limit):
    held = skewed.collect()
    for found in ordered.quantiles(skewed, "v", SHARES, ["g"]).collect():
        values = [r["v"] for r in held if r["g"] == found["g"]]
        assert found["n"] == len(values)
        assert list(found["q"]) == pytest.approx(list(np.quantile(values, SHARES)))


@pytest.mark.parametrize("kind", ["brackets", "whole groups", "ordered by many tasks", "sketch that misses"])
def test_quantiles_equal_percentile_to_the_last_digit(spark, monkeypatch, kind):
    """A third of the rows share a value, one group is small, one has a null name; shares in no order."""
    if kind != "whole groups":
        monkeypatch.setattr(ordered, "WHOLE_ROWS", 50)
        monkeypatch.setattr(ordered, "ACCURACY", 100)
        monkeypatch.setattr(ordered, "MARGIN", 0.0 if kind == "sketch that misses" else 0.03)
    if kind == "ordered by many tasks":
        monkeypatch.setattr(ordered, "KEYS_PER_TASK", 10)
    table = spark.range(0, 9_000, 1, 7).selectExpr(
        "IF(id % 3 = 0, 5D, pmod(xxhash64(id), 100000) / 7D) AS v",
        "CASE WHEN id < 40 THEN 'small' WHEN id % 4 > 0 THEN 'large' END AS g")
    table = table.unionByName(spark.sql("SELECT * FROM VALUES (double('inf'), 'large'), (double('-inf'), 'large'), (double('nan'), 'large'), (NULL, 'none') AS t(v, g)"))
    shares = [0.99, 0.01, 0.1, 0.25, 0.37, 0.5, 0.9, 0.0, 1.0, 0.5]
    for by in ([], ["g"]):
        clean = table.where("NOT isnan(v) AND v IS NOT NULL")
        wanted = clean.groupBy(*by).agg(F.count("*").alias("n"), F.percentile("v", shares).alias("q"))
        found = ordered.quantiles(table, "v", shares, by)
        assert found.columns == [*by, "n", "q"]
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    none = ordered.quantiles(table.limit(0), "v", shares).collect()
    assert [tuple(r) for r in none] == [(0, None)] and ordered.quantiles(table.limit(0), "v", shares, ["g"]).count() == 0


def test_only_values_next_to_a_share_are_counted_apart(spark):
    table = spark.range(0, 200_000, 1, 8).selectExpr("CAST(pmod(xxhash64(id), 1000000007) AS double) AS _v")
    shares = [0.25, 0.5, 0.75]
    cells = ordered._cells(table, ordered._brackets(table, shares, []), len(shares), [])
    assert cells.count() < 200_000 * 3 * 3 * ordered.MARGIN
    assert cells.agg(F.sum("_n")).first()[0] == 200_000
    plan = cells._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2  # combined per task first


def test_many_groups_use_a_checkpoint(skewed, monkeypatch):
    monkeypatch.setattr(ordered, "KEYS_PER_TASK", 10)
    monkeypatch.setattr(rows, "MAX_LOCAL_ROWS", 1)
    held = skewed.collect()
    for found in ordered.quantiles(skewed, "v", [0.5], ["g"]).collect():
        assert found["q"][0] == pytest.approx(np.median([r["v"] for r in held if r["g"] == found["g"]]))


def test_running_totals(skewed, limit):
    values = sorted(r["v"] for r in skewed.collect())
    found = ordered.running_totals(skewed, "v", {"n": F.count(F.lit(1))}).collect()
    assert sum(r["n"] for r in found) == len(values)
    for r in found[::97]:
        assert r["n_before"] == np.searchsorted(values, r["v"]) and r["n_all"] == len(values)


def test_sample_size_is_exact_and_independent_of_partitions(skewed, limit):
    ids = []
    for parts in (1, 7):
        drawn = ordered.sample_n(skewed.repartition(parts), 500, "id")
        ids.append(sorted(r["id"] for r in drawn.select("id").collect()))
    assert len(ids[0]) == 500 and ids[0] == ids[1]
    everything = skewed.select("id", ordered.hash_key("id", 42).alias("h")).orderBy("h", "id").limit(500)
    assert ids[0] == sorted(r["id"] for r in everything.collect())


def test_small_and_oversized_samples(skewed):
    assert ordered.sample_n(skewed, 10, "id").count() == 10
    assert ordered.sample_n(skewed, 99_999, "id").count() == 9_000


def test_split_is_exact_proportional_and_independent_of_partitions(skewed, limit):
    drawn = []
    for parts in (1, 7):
        split = preparation.stratified_split(preparation.stratify_bins(skewed.repartition(parts), "v"))
        drawn.append(sorted((r["id"], r["stratum"]) for r in split.where("split = 'test'").collect()))
        assert split.count() == 9_000
    assert drawn[0] == drawn[1] and len(drawn[0]) == 900
    sizes = {r["stratum"]: r["count"] for r in split.groupBy("stratum").count().collect()}
    for stratum, size in sizes.items():
        assert abs(sum(s == stratum for _, s in drawn[0]) - size / 10) < 1


REPEATED = {
    "each id twice": "id div 2", "one id on a third of the rows": "IF(id % 3 = 0, 7, id)", "only one id": "1",
    "null ids": "IF(id % 3 = 0, NULL, id div 4)",
}


@pytest.mark.parametrize("kind", sorted(REPEATED))
@pytest.mark.parametrize("told_apart", [True, False])
def test_draws_are_exact_when_ids_repeat(spark, monkeypatch, kind, told_apart):
    monkeypatch.setattr(ordered, "KEYS_PER_TASK", 200)
    columns = ["id", "k", "CAST(stratum AS int) AS stratum", *(["nr"] if told_apart else [])]  # without nr rows are alike
    table = spark.range(1_200).selectExpr(f"{REPEATED[kind]} AS id", "id % 2 AS k", "id AS nr", "id % 2 AS stratum").selectExpr(*columns)
    drawn = []
    for parts in (1, 7):
        rows = table.repartition(parts)
        split = preparation.stratified_split(rows, "id", "stratum", 0.1).collect()
        sample = ordered.sample_n(rows, 317, "id").collect()
        assert len(split) == 1_200 and len(sample) == 317
        assert [sum(r["split"] == "test" and r["stratum"] == g for r in split) for g in (0, 1)] == [60, 60]
        drawn.append((sorted(map(str, split)), sorted(map(str, sample))))
    assert drawn[0] == drawn[1]
    assert ordered.sample_n(table, 7, "id").count() == 7


def test_levels_count_what_is_left(spark, monkeypatch):
    """One id on a third of the rows: the digits that it shares with no other id run out at last."""
    monkeypatch.setattr(ordered, "KEYS_PER_TASK", 5)
    table = spark.range(3_000).selectExpr("IF(id % 3 = 0, -1, id) AS id", "id AS nr")
    keyed = table.select(F.lit(0).alias("_group"), ordered.hash_key("id", 42).alias("_key"))
    keys = sorted(r["_key"] for r in keyed.collect())
    for n in (1, 999, 1_500, 3_000):
        key, take, tied = ordered._last_taken(keyed, {0: n}, {0: 3_000})[0]
        assert key == keys[n - 1] and tied == keys.count(key) and take == n - keys.index(key)


def test_quotas_add_up():
    quotas = ordered.largest_remainder({0: 5, 1: 5, 2: 5, -1: 6}, 0.1)
    assert sum(quotas.values()) == 3 and quotas[-1] == 1


def test_hot_key_rows_are_spread(spark):
    table = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    found = table.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = ordered.attach_by_key(table, found, "k", "n", "id")
    assert joined.count() == 3_000
    assert {r["n"] for r in joined.where("k = 'hot'").collect()} == {1_000}
    assert {r["n"] for r in joined.where("k <> 'hot'").collect()} == {1}
