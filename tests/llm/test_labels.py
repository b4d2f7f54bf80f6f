"""Language and quality: held-out accuracy, brute force on small texts, edge cases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from jobmine.llm import language_id, quality
from jobmine.llm.arrow_text import slices

SF = "/root/testdata/sf0.01"


def grams(text):
    low = re.sub(r"[^a-zéèüßñ]+", " ", text.lower()).strip()
    out = Counter()
    padded = f" {low} "
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i:i + n]
            inner = g if n == 1 else g[1:-1]
            if " " not in inner and g.strip():
                out[g] += 1
    return out


def ranked(counts, size):
    # A separator orders before every letter; shorter n-grams before longer ones.
    order = sorted(counts, key=lambda g: (-counts[g], len(g), g))
    return {g: i for i, g in enumerate(order[:size])}


def test_distances_against_brute_force(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien été", "fr"), (3, "der Hund, die Katze!", "de"), (4, "the the tree", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.learn(docs, size=30)
    known = {}
    for lang in ("de", "en", "fr"):
        known[lang] = ranked(sum((grams(t) for _, t, lg in rows if lg == lang), Counter()), 30)
    texts = ["the dog", "le chien", "Katze der", "zzz", "", "123 !!", "THE-Cat été"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.identify(asked, profiles).collect():
        own = ranked(grams(texts[r["doc_id"]]), 30)
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        far = {lang: sum(abs(p[g] - i) if g in p else 30 for g, i in own.items()) for lang, p in known.items()}
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best and abs(r["score"] - (1 - far[best] / (30 * len(own)))) < 1e-9


def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.op2(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_language_edge_cases(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "...", "en"), (2, "...", "en"), (3, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS gram", "2 AS score")
    assert {r["lang_pred"] for r in language_id.op2(docs).collect()} == {"und"}
    assert language_id.op2(docs.limit(0)).count() == 0


def test_keep_known_keeps_whole_rows(spark):
    rows = [(1, "the cat", "en", 7), (2, "42", "en", 8), (3, "日本語", "en", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred long")
    profiles = language_id.learn(docs.where("doc_id = 1"))
    assert [tuple(r) for r in language_id.keep_known(docs, profiles).collect()] == [rows[0]]


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.op6(docs, labels).where("held_out").join(labels, "doc_id")
    assert found.where("predicted = quality").count() >= 0.95 * found.count()
    assert found.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.3)").isEmpty()


def test_discriminant_against_densities(spark):
    draw = np.random.default_rng(1)
    size = len(quality.FEATURES)
    x = np.concatenate([draw.normal(0, 1, (60, size)), draw.normal(1, 2, (90, size))])
    y = [0] * 60 + [1] * 90
    table = spark.createDataFrame([(row.tolist(), k) for row, k in zip(x, y, strict=True)], "x array<double>, label int")
    model = quality.fit(table, pooled=0.2, identity=0.1)
    z = (x - x.mean(0)) / x.std(0)
    parts = [z[:60], z[60:]]
    covs = [np.cov(p.T, bias=True) for p in parts]
    whole = (60 * covs[0] + 90 * covs[1]) / 150
    logs = []
    for p, c in zip(parts, covs, strict=True):
        own = 0.8 * c + 0.2 * whole
        own = 0.9 * own + 0.1 * np.eye(size) * np.trace(own) / size
        off = z - p.mean(0)
        apart = np.einsum("ij,jk,ik->i", off, np.linalg.inv(own), off)
        logs.append(np.log(len(p) / 150) - 0.5 * apart - 0.5 * np.linalg.slogdet(own)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))))


def test_quality_edge_cases(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "\n\n"), (3, "a b\na b\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS x", "2 AS label")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.op6(docs, none).collect()} == {0.5}
    assert quality.op6(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, 1), (3, None), (2, 7)], "doc_id long, quality int")
    assert quality.op6(docs, odd).count() == 5


def test_statistics_are_finite():
    texts = pa.array(["", "\n", "word", "A|B|C 1*** x%%%", "é" * 300, " ".join(["same line\n"] * 9)])
    (_, _, data, bounds), = slices(texts)
    x = quality.statistics(data, bounds)
    assert x.shape == (6, len(quality.FEATURES)) and np.isfinite(x).all()


def test_profiles_do_not_depend_on_the_memory_of_a_task(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang")
    whole = language_id.learn(docs)
    monkeypatch.setattr(language_id, "MERGE_AT", 500)
    few = language_id.learn(docs)
    assert whole.languages == few.languages
    for a, b in zip([*whole.grams, *whole.ranks], [*few.grams, *few.ranks], strict=True):
        assert (a == b).all()
