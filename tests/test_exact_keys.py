"""Keys of typed columns, close distributions, and rows that repeat an id."""

import math

import pytest
from pyspark.sql import functions as F

from jobmine.operators import clustering, preparation
from jobmine.operators.rows import row_digest
from jobmine.operators.shift import ks_pvalue


def test_digest_of_typed_columns(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        (1, timestamp'2024-01-01 00:00:00.000001', 0.0D, X'00', array(1, null)),
        (2, timestamp'2024-01-01 00:00:00.000002', -0.0D, X'00', array(1, null)),
        (3, timestamp'2024-01-01 00:00:00.000001', -0.0D, X'00', array(1, null)),
        (4, null, double('NaN'), X'01', array(null, 1)), (5, null, double('NaN'), X'01', array(null, 1)) AS t(i, t, d, b, a)""")
    keys = {r["i"]: r["k"] for r in rows.select("i", row_digest(rows, ["t", "d", "b", "a"]).alias("k")).collect()}
    assert keys[1] == keys[3] != keys[2] and keys[4] == keys[5] and len(set(keys.values())) == 3


def test_every_distinct_time_stays(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    kept = preparation.dedup(events, ["ts"], "event_id")
    assert kept.count() == events.select("ts").distinct().count()


def _exact(x):
    if x < 0.3:
        return 1 - math.sqrt(2 * math.pi) / x * sum(math.exp(-((2 * k - 1) * math.pi / x) ** 2 / 8) for k in range(1, 60))
    return 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 400))


@pytest.mark.parametrize("scale", [1e-4, 0.02, 0.2, 0.5, 0.9, 1.0, 1.1, 2.0, 5.0])
def test_ks_pvalue(spark, scale):
    n, m = 5e7, 6e6
    distance = scale / math.sqrt(n * m / (n + m))
    got = spark.range(1).select(ks_pvalue(F.lit(distance), F.lit(n), F.lit(m)).alias("p")).first()["p"]
    assert got == pytest.approx(_exact(scale), abs=1e-9)


def test_minibatch_sees_every_row(spark):
    rows = [(i, [float(i % 3) * 100 + (i % 7) / 10, float(i % 3)]) for i in range(500)]
    points = spark.createDataFrame(rows, "id long, features array<double>")
    model = clustering.minibatch_kmeans_fit(points, 3, batch_size=10, max_batches=4)
    assert model.fit_rows == 500
    means = sorted(sum(p[0] for i, p in rows if i % 3 == k) / sum(i % 3 == k for i, _ in rows) for k in range(3))
    # One pass of running means over all rows ends at the means of the groups.
    assert sorted(c[0] for c in model.centers) == pytest.approx(means, abs=0.2)
