"""Removal of repeated passages against brute force over every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd

from jobmine.llm import suffix_dedup
from jobmine.llm.suffix_dedup import op10, remove_repeats


def brute(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha) for distinct, ordered (id, text)."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(op10(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_planted_repeats(spark):
    draw = random.Random(3)

    def words(n):
        return " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 7))) for _ in range(n))

    passage, other = words(40), words(60)
    rows = [(0, words(80)), (1, words(30) + passage + words(30)), (2, passage + words(5) + passage[:120] + words(9)),
            (3, "x" * 450), (4, "ab" * 300), (5, other), (6, other + "!"), (7, other), (8, "y" + other[:130]),
            (9, None), (10, ""), (11, other[:99]), (12, other[:100]), (13, words(20) + "x" * 101), (14, words(3000)), (15, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS chunk", "text AS data")
    assert result(op10(docs.repartition(4))) == brute(rows)
    assert result(remove_repeats(docs.repartition(5), chunk_bytes=300, bucket_items=3, batches=7)) == brute(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    text = "some words that go on and on " * 9
    rows = [(None, text), (4, text), (4, text), (4, "other " * 30), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in op10(docs).collect())
    kept = brute([(0, text)])[0][1]
    lost = brute([(0, "other " * 30)])[0][1]
    assert found == sorted([(-1, 0, 0), (-1, len(text), kept), (4, len(text), len(text)), (4, len(text), len(text)), (4, 180, lost)])
    assert op10(docs.limit(0)).count() == 0


def test_hot_suffix_is_dealt_over_groups(spark, monkeypatch):
    draw = random.Random(8)
    passage = "".join(draw.choices("abcdefgh ", k=150))

    def around(n):
        return "".join(draw.choices("abcdefgh ", k=n))

    rows = [(i, around(90) + passage + around(90)) for i in range(120)]
    rows += [(120 + i, around(40) + rows[i][1][30:260]) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    limits = dict(chunk_bytes=1500, hot_windows=400, dealt_windows=300)
    assert result(remove_repeats(docs, **limits)) == brute(rows)

    def bounded(length):
        compare = whole(length)

        def checked(group):
            of_key = Counter()
            for r in group.itertuples():
                windows = suffix_dedup.unpack(r.sizes, "int64") - length + 1
                for key, n in zip(suffix_dedup.unpack(r.keys, "uint64").tolist(), windows.tolist(), strict=True):
                    of_key[key] += n
            assert max(of_key.values()) <= 400
            return compare(group)

        return checked

    whole = suffix_dedup._compare
    monkeypatch.setattr(suffix_dedup, "_compare", bounded)
    assert result(remove_repeats(docs, **limits)) == brute(rows)


def test_chunks_grow_with_the_table(spark, monkeypatch):
    draw = random.Random(4)
    passage = "".join(draw.choices("abcdefgh ", k=200))
    rows = [(i, "".join(draw.choices("abcdefgh ", k=300)) + passage * (i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    total, sizes, whole = sum(len(t) for _, t in rows), [], suffix_dedup.chunks
    monkeypatch.setattr(suffix_dedup, "chunks", lambda df, size: sizes.append(size) or whole(df, size))
    monkeypatch.setattr(suffix_dedup, "CHUNKS", 5)
    for least, most in ((1, 1 << 20), (1, 900), (1 << 20, 1 << 24)):
        monkeypatch.setattr(suffix_dedup, "LEAST_CHUNK", least)
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", most)
        assert result(op10(docs)) == brute(rows)
    assert sizes == [total // 5, 900, 1 << 20]


def test_windows_of_a_cell_are_added_up_before_they_leave_a_task():
    keys, sizes = np.array([5, 5, 9], np.uint64), np.array([100, 104, 199])
    frame = pd.DataFrame({"bucket": [0, 0], "keys": [suffix_dedup.pack(keys)] * 2, "sizes": [suffix_dedup.pack(sizes)] * 2})
    found = list(suffix_dedup._cell_sizes(1, 100)([frame, frame]))
    cells = suffix_dedup._cells(keys, 0, 1)
    wanted = Counter()
    for cell, n in zip(cells.tolist(), (1, 5, 100), strict=True):
        wanted[cell] += 4 * n
    assert len(found) == 1 and dict(zip(found[0]["cell"], found[0]["windows"], strict=True)) == wanted
