"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector, and a
fingerprint is the sum of the vectors modulo powers of two: so the order of paragraphs does not
matter, inserting a paragraph adds its vector, deleting one subtracts it, and the fingerprints of
parts add up to that of the whole. A vector has two kinds of lanes:

- eight lanes modulo 2^64 from a 512-bit digest of the whole paragraph, which tell different multisets
  apart;
- 256 lanes modulo 2^16, each plus or minus one for every short run of words in the paragraph. The
  squared length of the difference of two such sums, over 256, estimates in how many runs two texts
  differ, so likeness (shared runs over all runs, 0 to 1) is known from fingerprints alone, with a
  standard error of about 0.05. Runs end where a word's hash says so, hence an edit changes only the
  runs it touches; a word of over 24 bytes counts as several.

Defined cases: a null text equals an empty one, which is one empty paragraph; equal fingerprints have
likeness 1, unequal ones without any word 0. Documents are ordered by id, nulls first, then by
text; the document after the last is the first, which may be the same one. Repeated rows each
count as a document. Empty tables give empty results. Very long texts are hashed whole, runs in
blocks. Other columns may have any names. Rows that share an id are read by one task, as a stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import SLICE_BYTES, mix, span_hashes, word_bounds
from jobmine.llm.common import narrow
from jobmine.session import stage

WIDE = 8
SIGNS = 256
BYTES = 8 * WIDE + 2 * SIGNS
LONG_WORD = 24
RUN_WORDS = 4  # on average
BLOCK_CHARS = 8 << 20
MAX_BLOCKS = 1 << 16
_RUNS_AT_ONCE = 1 << 14
_KEEP_PARTS = 4_096
_U = np.uint64


def _runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of words of each text, and the text of each run."""
    starts, ends = word_bounds(data, bounds)
    pieces = (ends - starts + LONG_WORD - 1) // LONG_WORD
    if len(starts) and pieces.max() > 1:
        word = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, last = starts[word] + nth * LONG_WORD, ends[word]
        ends = np.minimum(starts + LONG_WORD, last)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lines = np.union1d(np.flatnonzero(data == 10), bounds)
    line = np.searchsorted(lines, starts, "right")
    cut = span_hashes(data, starts, ends) % _U(RUN_WORDS) == 0
    cut[:-1] |= line[1:] != line[:-1]
    cut[-1] = True
    last = np.flatnonzero(cut)
    first = np.concatenate([[0], last[:-1] + 1])
    owner = np.searchsorted(bounds, starts[first], "right") - 1
    return span_hashes(data, starts[first], ends[last]), owner


def _sign_sums(hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Per text the sum over its runs of vectors of plus and minus one, modulo 2^16."""
    total = np.zeros((rows, SIGNS), np.int32)
    for at in range(0, len(hashes), _RUNS_AT_ONCE):
        some, own = hashes[at:at + _RUNS_AT_ONCE], owner[at:at + _RUNS_AT_ONCE]
        words = np.empty((len(some), SIGNS // 64), np.uint64)
        for k in range(SIGNS // 64):
            words[:, k] = mix(some + _U(0x9E3779B97F4A7C15 * (k + 1) % 2 ** 64))
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        count = np.diff(np.append(first, len(own))).astype(np.int32)
        total[own[first]] += 2 * ones - count[:, None]
    return total.astype(np.int16)


def _wide_sums(texts: list[bytes]) -> np.ndarray:
    """Per text the sum of its paragraphs' digests, lane by lane modulo 2^64."""
    total = np.zeros((len(texts), WIDE), np.uint64)
    for at, text in enumerate(texts):
        lines = text.split(b"\n")
        digests = b"".join([hashlib.blake2b(x).digest() for x in lines])
        total[at] = np.frombuffer(digests, np.uint64).reshape(-1, WIDE).sum(0, dtype=np.uint64)
    return total


def vectors(texts: list[bytes]) -> np.ndarray:
    """A row of ``BYTES`` bytes per text: its fingerprint."""
    out = np.empty((len(texts), BYTES), np.uint8)
    at = 0
    while at < len(texts):
        last, size = at, 0
        while last < len(texts) and (last == at or size + len(texts[last]) <= SLICE_BYTES):
            size += len(texts[last])
            last += 1
        part = texts[at:last]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
        hashes, owner = _runs(np.frombuffer(b"".join(part), np.uint8), bounds)
        out[at:last, :8 * WIDE] = _wide_sums(part).view(np.uint8)
        out[at:last, 8 * WIDE:] = _sign_sums(hashes, owner, len(part)).view(np.uint8)
        at = last
    return out


def add(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprints with others inserted (``sign`` 1) or deleted (-1)."""
    def lanes(x, part, kind):
        return np.ascontiguousarray(x[:, part]).view(kind)

    out = np.empty(np.broadcast_shapes(a.shape, b.shape), np.uint8)
    for part, kind in ((slice(0, 8 * WIDE), np.uint64), (slice(8 * WIDE, BYTES), np.uint16)):
        own, other = lanes(a, part, kind), lanes(b, part, kind)
        out[:, part] = (own + other if sign > 0 else own - other).view(np.uint8)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of runs that two texts have in common, from their fingerprints."""
    own, other = (np.ascontiguousarray(x[:, 8 * WIDE:]).view(np.int16) for x in (a, b))
    apart = (own - other).astype(np.float64)  # the difference modulo 2^16 is small where texts are alike
    squared = [(x.astype(np.float64) ** 2).sum(1) for x in (own, other, apart)]
    known = squared[0] + squared[1]
    share = np.clip((known - squared[2]) / np.maximum(known + squared[2], 1.0), 0.0, 1.0)
    return np.where((a == b).all(1), 1.0, share)


def _hex(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes().hex() for x in rows], pa.string())


def _bytes(texts: pa.Array) -> list[bytes]:
    return pc.fill_null(texts, "").cast(pa.binary()).to_pylist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the binary fingerprint of every row."""
    source = narrow(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            found = [x.tobytes() for x in vectors(_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("fingerprint", T.BinaryType())]))


def merged(parts: DataFrame, key: str) -> DataFrame:
    """The sum of the fingerprints of each ``key``: those of a group of documents, or of a document and
    its changes (``changes``). Added up in each task first, so a key of any size is a row per task."""
    kind = T.StructType([T.StructField(key, parts.schema[key].dataType), T.StructField("fingerprint", T.BinaryType())])

    def sums(held: dict, of: pa.DataType) -> pa.RecordBatch:
        values = pa.array([x.tobytes() for x in held.values()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(held), of), values], kind.names)

    def run(batches):
        held: dict = {}
        of = None
        for batch in batches:
            of = batch.column(0).type
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BYTES)
            for at, name in enumerate(batch.column(0).to_pylist()):
                row = rows[at:at + 1]
                held[name] = add(held[name], row) if name in held else row
            if len(held) > _KEEP_PARTS:
                last = list(held)[-1]  # where rows come in order, this key may go on
                rest = held.pop(last)
                yield sums(held, of)
                held = {last: rest}
        if held:
            yield sums(held, of)

    some = parts.select(key, "fingerprint").mapInArrow(run, kind)
    return some.repartition(key).sortWithinPartitions(key).mapInArrow(run, kind)


def changes(edits: DataFrame, id_col: str = "doc_id", text_col: str = "text", sign_col: str = "sign") -> DataFrame:
    """doc_id and the fingerprint to add for each inserted (sign 1) or deleted (-1) paragraph."""
    source = edits.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(sign_col).alias("sign"))
    zero = np.zeros((1, BYTES), np.uint8)

    def run(batches):
        for batch in batches:
            found = vectors(_bytes(batch.column(1)))
            found = [x.tobytes() if s > 0 else add(zero, x[None], -1).tobytes() for x, s in zip(found, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("fingerprint", T.BinaryType())]))


def _block(docs: DataFrame, block_chars: int) -> DataFrame:
    """Append ``block``, a number that grows with the id; blocks hold about ``block_chars`` characters."""
    known = docs.agg(F.sum(F.length("text")).alias("chars"), F.count("doc_id").alias("ids")).first()
    blocks = min(MAX_BLOCKS, -(-(known["chars"] or 0) // block_chars))
    shares = [i / blocks for i in range(1, blocks)] if known["ids"] else []
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("double"), shares, 100_000)).first()[0] if shares else []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return docs.withColumn("block", F.lit(0))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))
    cut = Bucketizer(splits=splits, inputCol="_place", outputCol="_block")
    return cut.transform(docs.withColumn("_place", place)).select(*docs.columns, F.col("_block").cast("int").alias("block"))


def with_next(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows dealt so that each task reads whole blocks in order, and after each block's rows the first
    row of the next block (``ahead``): block, ahead, doc_id, text. ``docs`` has doc_id and text."""
    spark = docs.sparkSession
    placed = _block(docs, block_chars)
    first = stage(placed.groupBy("block").agg(F.min(F.struct("doc_id")).alias("first")), "first-of-block")
    blocks = sorted(r["block"] for r in first.select("block").collect())  # MAX_BLOCKS at most
    before = spark.createDataFrame(list(zip(blocks, blocks[-1:] + blocks[:-1], strict=True)) or [(0, 0)], "_of int, _before int")
    heads = F.broadcast(first.join(F.broadcast(before), first["block"] == before["_of"]).select(
        "_of", "_before", F.col("first.doc_id").alias("_id")))
    same = (placed["block"] == heads["_of"]) & placed["doc_id"].eqNullSafe(heads["_id"])
    ahead = placed.join(heads, same).groupBy(F.col("_before").alias("block")).agg(
        F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
    rows = placed.select("block", F.lit(0).alias("ahead"), "doc_id", "text").unionByName(
        ahead.select("block", F.lit(1).alias("ahead"), "doc_id", "text"))
    return rows.repartition("block").sortWithinPartitions("block", "ahead", "doc_id", "text")


def op11(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    rows = with_next(narrow(docs), block_chars)
    out = T.StructType([
        rows.schema["doc_id"], T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])

    def pairs(ids, ahead, texts, own):
        """Results of the rows that have their next row here: all but the last and those ahead."""
        at = np.flatnonzero(ahead[:-1] == 0)
        if not len(at):
            return None
        sizes, edited = [], []
        for i in at:
            text = texts[i].decode()
            half = len(text) // 2
            sizes.append(len(text))
            edited.append((text[:len(text) - half] + texts[i + 1].decode()[:half]).encode())
        changed = vectors(edited)
        return pa.RecordBatch.from_arrays([
            ids.take(pa.array(at)), pa.array(sizes, pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in edited]), _hex(own[at]), _hex(changed),
            pa.array(likeness(own[at], changed)), pa.array(likeness(own[at], own[at + 1])),
        ], out.names)

    def run(batches):
        held = None  # the last row, which waits for the next one
        for whole in batches:
            texts_in = pc.fill_null(whole.column(3), "")
            sizes = np.cumsum(pc.binary_length(texts_in).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            start = 0
            while start < len(whole):
                upto = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + 4 * SLICE_BYTES, "right"))
                upto = min(max(upto, start + 1), start + 4_096)
                texts = _bytes(texts_in.slice(start, upto - start))
                own = vectors(texts)
                ahead = whole.column(1).slice(start, upto - start).to_numpy(zero_copy_only=False)
                ids = whole.column(2).slice(start, upto - start)
                if held is not None:
                    ids = pa.concat_arrays([held[0], ids])
                    ahead = np.concatenate([held[1], ahead])
                    texts = held[2] + texts
                    own = np.concatenate([held[3], own])
                found = pairs(ids, ahead, texts, own)
                if found is not None:
                    yield found
                held = ids.slice(len(ids) - 1), ahead[-1:], texts[-1:], own[-1:]
                start = upto

    return rows.mapInArrow(run, out)
