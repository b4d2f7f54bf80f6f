"""Hard negatives against brute force, and the tree's elimination."""

import math

import numpy as np
import pytest

from jobmine.llm import hard_negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    sound = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        sound.append((i, label, tuple(min(max(math.floor(256 * float(np.float32(x))), -2 ** 24), 2 ** 24) for x in v)))
    out = []
    for i, label, v in sorted({r for r in sound if r[0] % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in sound if j != i)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and -80 * ps <= -100 * s[0] <= -100 * ps][:negatives]
            out += [(i, p, rank + 1, j, -ps, -s) for rank, (s, j, _) in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(draw, n, width=12, centers=9, noise=0.25):
    middle = draw.normal(size=(centers, width))
    rows = middle[draw.integers(0, centers, n)] + noise * draw.normal(size=(n, width))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


@pytest.mark.parametrize("sample_rows,block", [(8_192, 8_192), (300, 7), (3, 4)])
def test_against_brute_force(spark, sample_rows, block):
    draw = np.random.default_rng(6)
    v = clustered(draw, 1_500)
    rows = [(int(i * 5), [float(x) for x in v[i]], int(draw.integers(0, 4))) for i in range(1_500)]
    rows += [(r[0] + 100_000, rows[3][1], r[2]) for r in rows[:400]]  # a vector that a fifth of the rows share
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1.0], 1), (200_000, None, 1), (200_100, [0.1, None], 2), (200_200, [nan], 1), (200_300, [inf], 1), (200_400, [0.5], None),
           (200_500, [], 3), (200_600, [0.9, -0.4], 1), (200_600, [0.9, -0.4], 1), (200_600, [0.9, 0.1], 2), (200_700, [1e30] + [0.0] * 11, 0),
           (200_701, [-1e30], 0), (200_702, [3e9], 2), (200_800, [-x for x in rows[0][1]], 77), (200_900, [0.0] * 12, 2), (201_000, [0.0] * 12, 3)]
    table = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS v", "3 AS idx").repartition(5)
    got = found(N.mine(table, block=block, sample_rows=sample_rows, leaf_rows=50))
    assert got == brute(rows + odd) and len(got) > 500


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.op12(empty).count() == 0 and N.op12(empty).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert N.op12(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)).count() == 0
    assert N.op12(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).count() == 0


def test_subtrees_are_left_out_and_never_wrongly(spark):
    draw = np.random.default_rng(8)
    v = np.floor(256 * clustered(draw, 6_000, noise=0.05))
    table = spark.createDataFrame([(int(i), 1, [int(x) for x in v[i]]) for i in range(len(v))], "vec_id long, label int, v array<int>")
    index = N.build(table, 1_000, 100)
    leaf = N._descend(index.tree, index.tree.lift(v))
    anchors = v[::100]
    reach, exact = N.Reach(index.tree, anchors), v @ anchors.T
    fifth = np.sort(exact, axis=0)[-6]
    visited = 0
    for at in np.unique(leaf):
        low, high = reach.scores(at)
        own = exact[leaf == at]
        assert (own >= low).all() and (own <= high).all()
        visited += (high >= fifth).sum() * len(own)
    assert len(np.unique(leaf)) > 20 and visited < 0.5 * exact.size


def test_recall_is_whole(spark):
    draw = np.random.default_rng(9)
    v = clustered(draw, 2_000, width=64, noise=0.6)
    rows = [(int(i), [float(x) for x in v[i]], int(draw.integers(0, 10))) for i in range(len(v))]
    assert found(N.op12(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
