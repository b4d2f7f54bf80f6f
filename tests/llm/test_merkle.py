"""Merkle manifests against a plain recomputation."""

import hashlib
import zlib

import pytest

from jobmine.llm import merkle
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout):
    """The last node, and per leaf the slots and siblings up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            run = nodes[place // fanout * fanout:][:fanout]
            paths[leaf].append((place % fanout, run[:place % fanout] + run[place % fanout + 1:]))
            at[leaf] = place // fanout
        nodes = [h(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs, own = [], {}
    for lang in langs:
        keyed = sorted(((r[0] is not None, r[0] or 0, h(*map(field, r))), r) for r in groups[lang])
        leaves = [k[2] for k, _ in keyed]
        sub, paths = tree(leaves, fanout)
        subs.append(sub)
        own[lang] = [(r, leaf, path) for (_, r), leaf, path in zip(keyed, leaves, paths, strict=True)]
    root, above = tree(subs, fanout)
    out = []
    for lang, sub, up in zip(langs, subs, above, strict=True):
        for row, leaf, path in own[lang]:
            i, source, _, n, text = row
            hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
            node = h(*map(field, (i, source, lang, n + hit if n is not None else None, text)))
            for slot, others in path + up:
                node = h(*others[:slot], node, *others[slot:])
            proof = h(*[x for _, others in path + up for x in others])
            out.append((i, leaf, sub, root, proof, node, node == root))
    return out


def found(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


ODD = [
    (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (2, "a", "en", 2 ** 63 - 1, "ä" * 3), (16, "a", "en", 2 ** 63 - 1, "x"),
    (16, "b", "en", 5, "x"), (3, "3:x", "ÿ", None, "0:"), (4, "s", "\U0001F600", 4, "long " * 300_000), (None, "s", "en", 1, "-"),
]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_against_plain(spark, fanout):
    rows = ODD + [(i, f"s{i % 3}", ["en", "de", None, "fr"][i % 13 % 4], i % 50, f"text {i}") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS node", "3 AS idx", "4 AS size")
    got = sorted(found(merkle.op13(docs.repartition(5), fanout)), key=key)
    want = sorted(plain(rows, fanout), key=key)
    assert got == want
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9])
def test_small_sizes(spark, size):
    rows = [(i, "s", "en", i, "t") for i in range(size)]
    got = sorted(found(merkle.op13(spark.createDataFrame(rows, SCHEMA))))
    assert got == (sorted(plain(rows)) if rows else [])


def test_partitions_do_not_matter(spark):
    rows = [(i % 90, "s", "en" if i % 4 else "de", i, f"t{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(found(merkle.op13(docs.repartition(7)))) == sorted(found(merkle.op13(docs.coalesce(1)))) == sorted(plain(rows))


def test_a_level_is_one_equijoin_and_runs_without_python(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "t") for i in range(40)], SCHEMA)
    leaves = docs.select(merkle.tree_key(F.col("lang")).alias("tree"), "doc_id", merkle.leaf([F.col("text")]).alias("node"))
    manifest = merkle.build(leaves, ["doc_id"])
    plan = merkle._siblings(manifest.groups.levels[1].select("tree", "idx", "size", "node"), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "Nested" not in plan and "Cartesian" not in plan
    whole = merkle.op13(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in whole and "Arrow" not in whole
