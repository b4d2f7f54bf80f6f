"""Multiset fingerprints against plain sums, exact texts and exact likeness."""

import hashlib

import numpy as np
import pytest

from jobmine.llm import fingerprints as P

SCHEMA = "doc_id long, text string"
WORDS = [f"word{i}" for i in range(5000)]


def wide(text):
    """Sum of the paragraphs' digests, lane by lane modulo 2^64."""
    total = [0] * P.WIDE
    for line in text.split("\n"):
        digest = hashlib.blake2b(line.encode()).digest()
        for k in range(P.WIDE):
            total[k] = (total[k] + int.from_bytes(digest[8 * k:8 * k + 8], "little")) % 2 ** 64
    return b"".join(x.to_bytes(8, "little") for x in total).hex()


def plain(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for at, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed, following = P.vectors([text.encode(), edited.encode(), after.encode()])
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
                    float(P.likeness(own[None], changed[None])[0]), float(P.likeness(own[None], following[None])[0])))
        assert out[-1][3][:16 * P.WIDE] == wide(text) and out[-1][4][:16 * P.WIDE] == wide(edited)
    return out


def key(row):
    return row[0] is not None, row[0] or 0, row[1:]


def text(draw, lines):
    return "\n".join(" ".join(draw.choice(WORDS, draw.integers(1, 30))) for _ in range(lines))


@pytest.mark.parametrize("block_chars", [10, 3_000, 10 ** 9])
def test_against_plain(spark, block_chars):
    draw = np.random.default_rng(3)
    rows = [(i * 7 % 301, text(draw, draw.integers(1, 9))) for i in range(150)]
    rows += [(None, None), (None, "x"), (400, ""), (401, "é" * 7), (402, "\U0001F600a\n\n"), (403, "a"), (403, "b"), (403, "b"), (404, "long line " * 300_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS ahead", "3 AS fingerprint")
    got = sorted([tuple(r) for r in P.op11(docs.repartition(5), block_chars).collect()], key=key)
    assert got == sorted(plain(rows), key=key)


@pytest.mark.parametrize("rows", [[], [(5, "only one")], [(1, None), (2, "")]])
def test_few_rows(spark, rows):
    assert sorted(tuple(r) for r in P.op11(spark.createDataFrame(rows, SCHEMA)).collect()) == plain(rows)


def test_one_id_on_a_third_of_the_rows(spark):
    rows = [(i if i % 3 else 9, f"text {i % 50}") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in P.op11(docs, 100).collect()) == sorted(plain(rows))


def test_order_of_paragraphs_does_not_matter_and_counts_do():
    one, other, twice, ends = P.vectors([b"a b c\nd e\nf", b"f\na b c\nd e", b"f\na b c\nd e\nf", b"f\na b c\nd e\n"])
    assert (one == other).all() and not (one == twice).all() and not (other == ends).all()


def test_inserting_and_deleting_paragraphs(spark):
    rows = [(1, "a b c\nd e\nf"), (2, "x y\nz"), (3, "stays")]
    edits = [(1, "new one", 1), (1, "d e", -1), (2, "z", -1), (2, "p q r", 1), (2, "p q r", 1)]
    before = P.fingerprints(spark.createDataFrame(rows, SCHEMA))
    change = P.changes(spark.createDataFrame(edits, SCHEMA + ", sign int"))
    after = {r["doc_id"]: bytes(r["fingerprint"]) for r in P.merged(before.unionByName(change), "doc_id").collect()}
    want = P.vectors([b"new one\na b c\nf", b"p q r\nx y\np q r", b"stays"])
    assert after == {i + 1: x.tobytes() for i, x in enumerate(want)}
    own = P.vectors([b"a b c\nd e\nf", b"d e"])
    assert (P.add(own[:1], own[1:], -1) == P.vectors([b"a b c\nf"])).all()


def test_groups_add_up_whatever_their_size(spark):
    rows = [(7 if i % 3 else i, f"line {i}\nand {i % 5}") for i in range(9_000)]
    found = {r["doc_id"]: bytes(r["fingerprint"]) for r in P.merged(P.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(4)), "doc_id").collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(i, []).append(t)
    want = dict(zip(groups, P.vectors(["\n".join(t).encode() for t in groups.values()]), strict=True))
    assert found == {i: x.tobytes() for i, x in want.items()}


def test_likeness_estimates_the_share_of_common_runs():
    draw = np.random.default_rng(5)
    a = [text(draw, 12) for _ in range(150)]
    b = ["\n".join(x.split("\n")[:k] + y.split("\n")[k:]) for k, x, y in zip(draw.integers(0, 13, 150), a, a[1:] + a[:1], strict=True)]

    def runs(t):
        data = t.encode()
        hashes, _ = P._runs(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        return hashes

    exact = []
    for x, y in zip(a, b, strict=True):
        own, other = runs(x), runs(y)
        names = np.unique(np.concatenate([own, other]))
        m, n = (np.array([(z == v).sum() for v in names]) for z in (own, other))
        exact.append((m * n).sum() / ((m * m).sum() + (n * n).sum() - (m * n).sum()))
    found = P.likeness(P.vectors([x.encode() for x in a]), P.vectors([x.encode() for x in b]))
    off = found - np.array(exact)
    assert abs(off.mean()) < 0.02 and off.std() < 0.06 and abs(off).max() < 0.2
