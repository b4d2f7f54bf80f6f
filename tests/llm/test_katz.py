"""Katz scores against a plain recursive model, and its probabilities' sums."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobmine.llm.katz import CUT, good_turing, op1, score_texts

WORD = re.compile("[^\x20\x09-\x0D]+")
END = object()


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + [END]


class Model:
    def __init__(self, texts):
        self.one, self.two, self.total = Counter(), Counter(), Counter()
        for text in texts:
            words = tokens(text)
            self.one.update(words)
            for pair in zip([None, *words], words, strict=False):
                self.two[pair] += 1
                self.total[pair[0]] += 1
        self.n = sum(self.one.values())
        self.d1, self.d2 = (good_turing(self.spectrum(c)) for c in (self.one, self.two))
        kept = sum(c * self.d1[min(c, CUT + 1)] for c in self.one.values()) / max(self.n, 1)
        self.scale1 = 1 if kept < 1 - 1e-9 else self.n / (self.n + 1)
        self.unknown = 1 - kept * self.scale1 if self.n else 1.0
        self.after = {}
        for (h, w), c in self.two.items():
            self.after.setdefault(h, {})[w] = c

    @staticmethod
    def spectrum(counter):
        by = Counter(counter.values())
        return [by[r] for r in range(1, CUT + 2)]

    def p1(self, w):
        c = self.one[w]
        return c * self.d1[min(c, CUT + 1)] * self.scale1 / self.n if c else self.unknown

    def p2(self, w, h):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        total = self.total[h]
        mass = sum(c * self.d2[min(c, CUT + 1)] for c in seen.values()) / total
        scale = total / (total + 1) if mass > 1 - 1e-9 else 1
        if w in seen:
            return seen[w] * self.d2[min(seen[w], CUT + 1)] / total * scale
        return (1 - mass * scale) / (1 - sum(self.p1(v) for v in seen)) * self.p1(w)

    def score(self, text):
        words = tokens(text)
        return sum(math.log10(self.p2(w, h)) for h, w in zip([None, *words], words, strict=False))


def rows_of(n, seed=5):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    return [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 40)))) for i in range(n)]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check(found, rows):
    model = Model([t for d, t in rows if not held(d)])
    assert len(found) == len(rows)
    for r, (doc, text) in zip(found, rows, strict=True):
        words = tokens(text)
        base = sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in words)
        assert (r["doc_id"], r["held_out"], r["n_tokens"]) == (doc, held(doc), len(words))
        assert r["n_known"] == sum(model.one[w] > 0 for w in words) and r["train_tokens"] == model.n
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(model.score(text), rel=1e-6)


def test_scores(spark):
    rows = [*rows_of(150), (150, None), (151, ""), (152, "never Seen words W1"), (153, "é É\tw1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "text AS codes")
    check(sorted(op1(docs.repartition(3)).collect(), key=lambda r: r["doc_id"]), rows)


def test_scores_do_not_depend_on_chunks_and_buckets(spark):
    rows = rows_of(80, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    check(sorted(score_texts(docs.repartition(2), bucket_items=50, chunk_bytes=400).collect(), key=lambda r: r["doc_id"]), rows)


def test_probabilities_sum_to_one():
    model = Model([t for _, t in rows_of(200)])
    for h in [None, "w0", "w1", "w50", "w119", "unseen"]:
        assert sum(model.p2(w, h) for w in [*model.one, "unknown"]) == pytest.approx(1)


def test_held_out_beats_the_base(spark):
    total = op1(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1]


def test_null_id_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [r["held_out"] for r in op1(docs).collect()] == [False, False]
    assert op1(docs.limit(0)).count() == 0


def test_backoff_weights_are_not_rounded(spark):
    rows = rows_of(80, 9)
    model = Model([text for doc, text in rows if not held(doc)])
    found = {r["doc_id"]: r["score"] for r in op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert max(abs(found[doc] - model.score(text)) for doc, text in rows) < 1e-10
