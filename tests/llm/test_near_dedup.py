"""Near-duplicates against brute force over all pairs of full shingle sets."""

import re

import numpy as np
import pyarrow as pa
import pytest

from jobmine.llm.arrow_text import slices
from jobmine.llm.components import components
from jobmine.llm.near_dedup import near_duplicates, op9, shingle_sets, sketches

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=2, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    at = {}
    for i, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in at[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {rows[i][0]: (len(sets[i]), min(groups[find(i)])) for i in range(len(rows))}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = op9(docs)
    assert result(found) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_chain_hub_and_edge_cases(spark):
    base = [f"w{i}" for i in range(60)]
    chain = [" ".join(base[k:k + 50]) for k in range(0, 10, 2)]
    spread = [" ".join([*base[:30], f"x{k}", *base[31:]]) for k in range(40)]
    rows = [(i, t) for i, t in enumerate([*chain, *spread, None, "", " \t", "one", "ONE", "one two", "é a", "É a"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bands", "2 AS node", "text AS comp")
    assert result(op9(docs.repartition(3))) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (3, "other words here now"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(str, near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()))
    want = [(3, 3, 3)] * 3 + [(None, 0, None), (None, 3, 3)]
    assert found == sorted(f"Row(doc_id={a}, n_shingles={b}, component_id={c})" for a, b, c in want)
    assert op9(docs.limit(0)).count() == 0


def test_sketches_estimate_similarity():
    texts = pa.array([" ".join(f"w{i}" for i in range(a, a + 200)) for a in (0, 20, 400)])
    (_, _, data, bounds), = slices(texts)
    sets = shingle_sets(data, bounds, 2)
    got = sketches(sets, 400)
    assert not (got == np.uint64(0xFFFFFFFFFFFFFFFF)).any()
    exact = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    assert abs((got[0] == got[1]).mean() - exact) < 0.08 and (got[0] == got[2]).mean() < 0.02


@pytest.mark.parametrize("size", [1, 2, 5])
def test_set_sizes(size):
    texts = ["a b a b a", "", "x", "A\tb\nc", "é z z"]
    (_, _, data, bounds), = slices(pa.array(texts))
    assert [len(s) for s in shingle_sets(data, bounds, size)] == [len(shingles(t, size)) for t in texts]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}}
