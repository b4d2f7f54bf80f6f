"""Exact dedup, packing, decontamination, license scan and quote links on small tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connection
from jobmine.llm import decontamination, exact_dedup, license_scan, packing, quote_links

SF = "/root/testdata/sf0.001"
WORDS = " ".join(f"w{i}" for i in range(40))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_queries_with_sql(spark, name):
    verdict, detail = compare(spark, connection(SF), SF, entry.LLM_QUERIES[name], entry.LLM_SQL[name])
    assert verdict == "ok", detail


def test_exact_dedup_edge_cases(spark):
    rows = [(1, "a", 0), (5, "a", 1), (5, "a", 2), (None, "a", 3), (None, "b", 4), (2, None, 5), (3, "", 6), (9, "A", 7)]
    docs = frame(spark, rows, "doc_id long, text string, digest int").repartition(3)
    found = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.op7(docs).collect())
    assert found == sorted([("1", "5", 4, False), ("5", "5", 4, True), ("5", "5", 4, True), ("None", "5", 4, False),
                            ("None", "None", 1, True), ("2", "3", 2, False), ("3", "3", 2, True), ("9", "9", 1, True)])
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(r["digest"] for r in kept.collect()) == [2, 4, 6, 7]
    assert exact_dedup.op7(docs.limit(0)).count() == 0 and exact_dedup.survivors(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words", [None, 1])
def test_survivors_whatever_the_filter(spark, monkeypatch, words):
    if words:  # a full filter: every row is a suspect
        monkeypatch.setattr("jobmine.operators.suspects.MIN_WORDS", words)
        monkeypatch.setattr("jobmine.operators.suspects.MAX_WORDS", words)
    long = "word " * 300_000
    rows = [(i, f"text {i % 211}" if i % 3 else "hot", i) for i in range(700)] + [(None, "hot", 1), (700, long, 2), (701, long, 3)]
    docs = frame(spark, rows, "doc_id long, text string, _text int").repartition(5)
    best = {}
    for i, text, _ in rows:
        best[text] = max(best.get(text, -1), -1 if i is None else i)
    kept = exact_dedup.survivors(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted((i, t) for t, i in best.items())


def test_digest_index_persists(spark, tmp_path):
    path = str(tmp_path / "index")
    old = frame(spark, [(7, "x"), (8, "y")])
    exact_dedup.deduplicate(old, index=exact_dedup.DigestIndex(spark, path)).collect()
    again = exact_dedup.DigestIndex(spark, path)
    new = frame(spark, [(90, "x"), (91, "z")])
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.deduplicate(new, index=again).collect()}
    assert found == {90: (7, False), 91: (91, True)} and again.rows().count() == 3
    joined = exact_dedup.text_digest(F.col("text"))
    plan = (new.select(joined.alias("digest")).repartition(again.buckets, "digest").hint("merge")
            .join(again.rows(), "digest", "left_anti")._jdf.queryExecution().toString())
    assert "SortMergeJoin" in plan and plan.split("Physical Plan")[1].count("Exchange") == 1


def test_packing(spark):
    draw = np.random.default_rng(2)
    rows = [(i, " ".join(["x"] * n)) for i, n in enumerate([*draw.integers(0, 90, 300).tolist(), 1000, 64, 65])] + [(None, None), (3, "\t")]
    docs = frame(spark, rows).selectExpr("*", "1 AS bin_id", "2 AS row", "3 AS grp")
    sizes = (16, 32, 64)
    found = packing.pack(docs.repartition(3), capacities=sizes, group_rows=50).collect()
    wanted = sorted((str(i), len((t or "").split())) for i, t in rows)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[str(r["doc_id"])].append((r["start"], r["n_tokens"]))
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    assert sorted((k, sum(n for _, n in v)) for k, v in pieces.items()) == sorted(
        (k, sum(n for j, n in wanted if j == k)) for k in {j for j, _ in wanted})
    assert sorted(pieces["300"]) == [(s, min(64, 1000 - s)) for s in range(0, 1000, 64)]
    for rs in bins.values():
        total = sum(r["n_tokens"] for r in rs)
        assert {r["bin_tokens"] for r in rs} == {total}
        assert {r["capacity"] for r in rs} == {min(c for c in sizes if c >= total)}
        at = 0
        for r in sorted(rs, key=lambda r: r["bin_start"]):
            assert r["bin_start"] == at
            at += r["n_tokens"]
    used = sum(r["n_tokens"] for r in found)
    assert sum(rs[0]["capacity"] for rs in bins.values()) < 1.2 * used
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN_ROWS", 7)  # copies are numbered in several runs
    rows = [(i % 400 if i % 50 else None, " ".join(["w"] * (i * 37 % 90))) for i in range(900)]
    rows += [(5, "a third of all")] * 300 + [(None, "rows alike")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for n in (2, 7):
        packed = packing.pack(docs.repartition(n, "text", "doc_id"), capacities=(16, 32, 64), group_rows=100)
        found.append(sorted(map(tuple, packed.collect()), key=repr))
    assert found[0] == found[1]
    assert sum(r[2] == 0 for r in found[0]) == len(rows)
    assert sum(r[3] for r in found[0]) == sum(len(t.split()) for _, t in rows)


def _plain_packing(sizes, capacities):
    """All prefixes of the permitted lengths, pieces by falling length, fullest bin first."""
    outcomes = []
    for longest in capacities:
        permitted, bins = [c for c in capacities if c <= longest], []
        if sizes and max(sizes) > longest:
            continue
        left = sum(sizes)
        for size in sorted(sizes, reverse=True):
            fitting = [b for b in bins if b[0] - b[1] >= size]
            if fitting:
                min(fitting, key=lambda b: b[0] - b[1])[1] += size
            else:
                best = min((c for c in permitted if c >= size), key=lambda c: packing.cost(c) / min(c, left))
                bins.append([best, size])
            left -= size
        outcomes.append(sum(packing.cost(min(c for c in capacities if c >= used)) for _, used in bins))
    return min(outcomes)


def test_packing_costs_what_a_plain_version_costs(spark):
    rng = np.random.default_rng(9)
    for top in (12, 40, 64):
        sizes = [int(n) for n in rng.integers(1, top + 1, 60)]
        docs = spark.createDataFrame([(i, " ".join(["w"] * n)) for i, n in enumerate(sizes)], "doc_id long, text string")
        found = packing.pack(docs, capacities=(16, 32, 64), group_rows=1000).collect()
        total = sum({r["bin_id"]: packing.cost(r["capacity"]) for r in found}.values())
        assert total == pytest.approx(_plain_packing(sizes, (16, 32, 64)))


def test_packing_is_jointly_cheapest():
    sizes = np.array(sorted(np.random.default_rng(4).integers(1, 65, 200).tolist(), reverse=True))
    _, _, joint = packing.pack_sizes(sizes, (16, 32, 64), 8.0, 64.0)

    def total(bins, final):
        first = {b: c for b, c in zip(bins.tolist(), final.tolist(), strict=True)}
        return sum(packing.cost(c, 8.0, 64.0) for c in first.values())

    bins, _, joint = packing.pack_sizes(sizes, (16, 32, 64), 8.0, 64.0)
    alone, _, single = packing.pack_sizes(sizes, (64,), 8.0, 64.0)
    assert total(bins, joint) <= total(alone, single)


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(30))
    bent = " ".join("zz" if i in (4, 13, 22) else f"q{i}" for i in range(30))
    short = "only seven words in this short item"
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "..."), (5, item)], "item_id long, text string")
    rows = [(0, f"{WORDS} {item} {WORDS}"), (1, f"lead {bent.upper()}"), (2, f"{WORDS} {short}!"), (3, WORDS), (4, None), (5, ""),
            (6, " ".join(item.split()[:15])), (7, " ".join(item.split()[:8]) + " " + WORDS), (8, item[3:]), (0, f"{WORDS} {item} {WORDS}")]
    docs = frame(spark, rows).selectExpr("*", "1 AS words", "2 AS hash", "3 AS text_key")
    found = {(r["doc_id"], r["item_id"], r["position"], r["n_equal"]) for r in decontamination.op5(docs, bench).collect()}
    for same in (1, 5):
        assert {f for f in found if f[1] == same} == {(0, same, 40, 30), (1, same, 1, 27), (6, same, 0, 15), (8, same, -1, 29)}
    assert {f for f in found if f[1] == 2} == {(2, 2, 40, 7)} and len(found) == 9
    assert sorted(r["doc_id"] for r in decontamination.clean(docs, bench).collect()) == [3, 4, 5, 7]
    blocks = decontamination.overlaps(docs, bench, block_hashes=10).select("doc_id", "item_id", "position", "n_equal")
    assert {tuple(r) for r in blocks.collect()} == found
    assert decontamination.op5(docs.limit(0), bench).count() == 0 and decontamination.op5(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_every_share(spark):
    draw = np.random.default_rng(5)
    items, docs, wanted = [], [], set()

    def copy(n, replaced):
        doc = len(docs)
        body = [f"r{doc}x{i}" if i in replaced else f"i{n}w{i}" for i in range(n)]
        docs.append((doc, " ".join([f"b{doc}"] * int(draw.integers(0, 4)) + body + [f"e{doc}", f"f{doc}"])))
        return doc

    for n in [*range(1, 46), 56, 100]:
        items.append((n, " ".join(f"i{n}w{i}" for i in range(n))))
        spare = n - int(np.ceil(n * 0.7))
        for _ in range(6):
            wanted.add((copy(n, set(draw.choice(n, spare, replace=False).tolist())), n))
        wanted.add((copy(n, set(range(3, n, 4)) if n // 4 <= spare else set()), n))
        if n <= 12:  # too short for NEAR equal words
            copy(n, set(draw.choice(n, spare + 1, replace=False).tolist()))
    found = decontamination.op5(frame(spark, docs).repartition(3), frame(spark, items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted
    assert all(r["share"] >= 0.7 for r in found)


def test_license_scan(spark):
    mit = license_scan.TEMPLATES[0][0]
    edited = mit.replace("without restriction", "with no further restriction")
    rows = [(0, "Under the MIT License, under the mit-license"), (1, f"{WORDS} {edited.title()} end"), (2, "cc by nc by nc cc by nc"),
            (3, None), (4, "under the mit"), (5, "Apache License, Version 2.0"), (5, "Apache License, Version 2.0"), (None, "é CC BY NC")]
    docs = frame(spark, rows).selectExpr("*", "1 AS words", "2 AS labels", "3 AS template")
    phrases = [(p.split(), label) for p, label in license_scan.PHRASES]
    for r in license_scan.op8(docs.repartition(2)).collect():
        text = next(t for i, t in rows if i == r["doc_id"])
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = [(i, label) for p, label in phrases for i in range(len(words)) if words[i:i + len(p)] == p]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        if r["doc_id"] == 1:
            assert r["labels"] == "mit" and r["n_base"] == 0
    assert license_scan.op8(docs.limit(0)).count() == 0


def test_license_variants(spark):
    texts = [(text, label) for text, label in license_scan.TEMPLATES]
    texts += [(f"{WORDS} {text} {WORDS}", label) for text, label in license_scan.TEMPLATES]
    cc = "This work is licensed under a Creative Commons {} International License."
    gnu = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General "
           "Public License as published by the Free Software Foundation; ")
    texts += [
        (cc.format("Attribution 4.0"), "cc-by"), (cc.format("Attribution 3.0"), "cc-by"),
        (cc.format("Attribution-Non-Commercial 4.0"), "cc-by-nc"), (cc.format("Attribution-ShareAlike 3.0"), "cc-by-sa"),
        (cc.format("Attribution-NonCommercial-ShareAlike 4.0"), "cc-by-nc,cc-by-sa"),
        (cc.format("Attribution 4.0") + " " + cc.format("Attribution-ShareAlike 4.0"), "cc-by,cc-by-sa"),
        (gnu.format("program", ""), "gpl"), (gnu.format("library", ""), "gpl"),
        (gnu.format("program", "Lesser "), "lgpl"), (gnu.format("library", "Library "), "lgpl"),
        (gnu.format("library", "Lesser ") + WORDS + " " + gnu.format("program", ""), "gpl,lgpl"),
        (gnu.format("program", "") + gnu.format("library", "Lesser "), "gpl,lgpl"),
        (gnu.format("program", "General or GNU Lesser "), "gpl,lgpl"),
    ]
    found = license_scan.op8(frame(spark, [(i, t) for i, (t, _) in enumerate(texts)]).repartition(3)).collect()
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in found}
    assert [(t, found[i]) for i, (t, _) in enumerate(texts)] == [(t, set(wanted.split(","))) for t, wanted in texts]


def test_quote_links(spark):
    rows = [
        ("a", 0, "u", "Hello there.\nHow are you?"),
        ("a", 1, "v", "> hello   THERE.\n> How are you?\nFine."),
        ("a", 2, "u", "> > Hello there.\n> > How are you?\n> Fine.\nGood.\n> unknown words\nBye."),
        ("a", 3, "w", "> Good.\nIndeed."),
        ("b", 0, "u", "Hello there.\nHow are you?"),
        ("b", 1, "v", "> Indeed.\nFrom elsewhere."),
        ("b", 2, "v", None), ("b", 2, "v", None), (None, None, None, ""),
    ]
    mails = frame(spark, rows, "s string, n int, r string, body string").selectExpr("*", "1 AS msg", "2 AS level")
    found = {(r["scope"], r["order"]): r for r in quote_links.link(mails, "s", "n", "r", "body").collect()}
    assert len(found) == 8

    def told(s, n):
        r = found[s, n]
        return r["parent_scope"], r["parent_order"], r["thread_scope"], r["thread_order"], r["depth"], r["n_quotes"], r["n_linked"], r["text"]

    assert told("a", 0) == (None, None, "a", 0, 0, 0, 0, rows[0][3])
    assert told("a", 1) == ("a", 0, "a", 0, 1, 1, 1, "Fine.")
    assert told("a", 2) == ("a", 1, "a", 0, 2, 3, 2, "Good.\nBye.")
    assert told("a", 3) == ("a", 2, "a", 0, 3, 1, 1, "Indeed.")
    assert told("b", 0)[:5] == (None, None, "b", 0, 0)
    assert told("b", 1)[:7] == (None, None, "b", 1, 0, 1, 0)  # the original is later than the reply
    assert told("b", 2) == (None, None, "b", 2, 0, 0, 0, "")
    assert quote_links.link(mails.limit(0), "s", "n", "r", "body").count() == 0


def test_quoted_conversations(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "text").collect()]
    by = {(c, n): t for c, n, t in rows}
    for r in quote_links.op4(table).collect():
        before = by.get((r["conv_id"], r["turn"] - 1))
        assert r["text"] == by[r["conv_id"], r["turn"]].strip(" \t\r\n")
        if before:
            assert r["parent_conv"] == r["conv_id"] and r["thread_turn"] == 0
            normal = " ".join(before.upper().lower().split())
            assert " ".join(by[r["conv_id"], r["parent_turn"]].upper().lower().split()) == normal
        else:
            assert r["depth"] == 0


def test_digest_is_sha256(spark):
    assert exact_dedup.op7(frame(spark, [(1, "é")])).first()["text_sha256"] == hashlib.sha256("é".encode()).hexdigest()
