"""The pipeline stage by stage against brute force, and its edge cases."""

import base64
import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def words(text):
    return [w for w in re.split("[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given = rows(docs)
    for at, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if at == 4:
            assert sorted({r["doc_id"] for r in out.collect()}) == sorted(i for i, _ in given)
            assert sum(r["n_tokens"] for r in out.collect()) == sum(len(re.findall("[^\x20\x09-\x0D]+", t)) for _, t in given)
            break
        assert out.columns == docs.columns
        kept = sorted(i for i, _ in rows(out))
        if name == "language":
            want = [i for i, t in given if re.search("[^\\W\\d_]", t)]
        elif name == "exact_dedup":
            want = sorted({t: max(i for i, u in given if u == t) for _, t in given}.values())
        elif name == "near_dedup":
            want = [i for i, (_, c) in brute(given, 5).items() if i == c]
        else:
            tokens = {i: " ".join(["", *words(t), ""]) for i, t in given}
            want = [i for i, t in tokens.items() if not any(" ".join(["", *x, ""]) in t for x in items)]
        assert kept == sorted(want), name
        docs, given = out, rows(out)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, name):
    function = dict(corpus_pipeline.STAGES)[name]
    odd = [(None, None, None, None), (1, "", "en", 1), (1, "", "en", 1), (2, "the cat sat on a mat", "en", 2), (2, "the cat sat on a mat", "en", 2)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, bands long")
    for rows_in in (docs, docs.limit(0)):
        out = function(spark, rows_in, SF)
        assert name == "pack" or out.columns == docs.columns
        assert out.count() <= len(odd)
    assert function(spark, docs.where("doc_id = 2").limit(1), SF).count() == 1


def test_language_stage_without_labels_keeps_every_text_with_a_letter(spark):
    rows = [(i, f"plain words of text number {i}", None) for i in range(20)] + [(90, "12 !!", None), (91, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).collect()) == list(range(20))


def test_language_stage_drops_unlearned_text_and_keeps_short_clean_text(spark):
    draw = random.Random(4)
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("text", "lang")
    texts = [tuple(r) for r in given.collect()]
    noise = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(n)) for n in (120, 200, 900)]
    noise += [base64.b64encode(draw.randbytes(900)).decode(),
              "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, obdarzeni rozumem i sumieniem. " * 5]
    short = ["the and of", "of", " ".join(texts[0][0].split()[:4])]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([*texts, *((t, None) for t in noise), *((t, None) for t in short)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).collect()}
    first, last = len(texts), len(texts) + len(noise)
    assert kept == set(range(first)) | set(range(last, last + len(short)))


def test_language_stage_learns_from_rows_of_every_fold(spark):
    rows = [(i, "der die das und nicht mit" if i % 2 else "the and of that with from", "de" if i % 2 else "en") for i in (2, 5, 8, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for one in [docs, *[docs.where(f"doc_id = {i}") for i, _, _ in rows]]:
        assert corpus_pipeline.language(spark, one, SF).count() == one.count()
