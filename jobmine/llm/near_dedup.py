"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is the set of its distinct word shingles. Its sketch has ``bands * rows`` coordinates,
filled in rounds: in round i every shingle is hashed to one coordinate and a value, and in the
second half of the rounds round i fills coordinate i itself, so every coordinate is filled; the
value of an earlier round wins, the smaller hash within a round. Two sketches agree in a coordinate
with the probability of the sets' similarity, concentrated around it, whatever the size of the sets.

Documents with equal sets are one node. Nodes that agree in a whole band meet in a bucket. To avoid
all pairs of a large group, rounds compare bucket members with one hub per bucket (first the most
central member, then one drawn by hash, a different one in each band), verify the pairs on the full
sets, join what is linked, and go on with buckets in which several components remain; the last round
compares all members of different components, so no pair that ever met in a band and could still
change the outcome is left out. A lower bound on the difference of two sets, from parities of their
items' hashes, rules most pairs out inside that join; it never rules out a pair that is similar. A pair at the threshold
0.8 meets in one of 40 bands of 5 rows with probability 1 - 1.2e-7; pairs above it surely enough.

Defined cases: null, empty and wordless texts have empty sets and link with nothing; a text with
fewer words than a shingle is one shingle. Rows that repeat an id keep their own sets; a null id is
larger than any other. Other columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import list_column, mix, slices, words
from jobmine.llm.common import narrow, text_key
from jobmine.llm.components import components
from jobmine.session import stage

BANDS, ROWS = 40, 5
FIRST_BANDS = 6
PARITY_WORDS = 32
_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
_BROADCAST_ROWS = 200_000


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every text."""
    hashes, at = words(data, bounds)
    width = max(0, len(hashes) - size + 1)
    joined = np.zeros(width, np.uint64)
    for k in range(size):
        joined = mix(joined + hashes[k:k + width] + _U(k + 1))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(joined[a:b - size + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                whole = mix(whole * _U(3) + hashes[k:k + 1])
            out.append(whole)
        else:
            out.append(joined[:0])
    return out


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` coordinates per set; sets are not empty."""
    counts = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), counts)
    filled = np.full(len(sets) * size, _EMPTY, np.uint64)
    for i in range(2 * size):
        drawn = mix(flat ^ mix(np.full(1, i + 1, np.uint64) * _U(0x9E3779B97F4A7C15)))
        if i < size:
            place = ((drawn >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)
        else:
            place = i - size
        value = (_U(i) << _U(48)) | (mix(drawn) >> _U(16))
        np.minimum.at(filled, owner * size + place, value)
        short = (filled.reshape(-1, size) == _EMPTY).any(1)
        if not short.any():
            break
        if i % 4 == 1:
            rest = short[owner]
            flat, owner = flat[rest], owner[rest]
    return filled.reshape(-1, size)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sketch), 1))
    parts = sketch.reshape(len(sketch), bands, rows)
    for k in range(rows):
        keys = mix(keys + parts[:, :, k])
    return keys


def parity(items: np.ndarray) -> np.ndarray:
    """Whether an odd number of items falls into each of some bins, as bits of 64-bit integers. Two
    sets differ in at least as many items as these bits differ."""
    bins = 64 * PARITY_WORDS
    odd = np.bincount((mix(items + _U(0x632BE59BD9B4E019)) & _U(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, parity, bands; ``docs`` has doc_id, text and text_key."""

    def sign(batches):
        for batch in batches:
            for a, b, data, bounds in slices(batch.column(1)):
                sets = shingle_sets(data, bounds, shingle)
                some = [s for s in sets if len(s)]
                keys = band_keys(sketches(some, bands * rows), bands, rows).view(np.int64)
                counts = np.array([len(s) for s in sets], np.int64)
                ends = np.concatenate([[0], np.cumsum((counts > 0) * bands)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(counts),
                    pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                    list_column(np.concatenate([parity(s) for s in sets]), np.arange(len(sets) + 1) * PARITY_WORDS),
                    list_column(keys.ravel(), ends)],
                    ["doc_id", "text_key", "n_shingles", "set_key", "parity", "bands"])

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_key", T.BinaryType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()), T.StructField("parity", T.ArrayType(T.LongType())),
        T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select("doc_id", "text", "text_key").mapInArrow(sign, schema)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """node and its sorted shingles; ``docs`` has node and text."""

    def gather(batches):
        for batch in batches:
            for a, b, data, bounds in slices(batch.column(1)):
                sets = shingle_sets(data, bounds, shingle)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), list_column(flat, ends)], ["node", "items"])

    return docs.select("node", "text").mapInArrow(gather, "node bigint, items array<bigint>")


def _facts(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("parity").alias(f"p{side}"))


def _possible(percent: int):
    """Whether sets a and b may be similar enough, by their sizes and a lower bound on their difference."""
    differ = F.lit(0)
    for i in range(PARITY_WORDS):
        differ = differ + F.bit_count(F.get("pa", F.lit(i)).bitwiseXOR(F.get("pb", F.lit(i))))
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return sizes & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb) whose full sets are similar enough, written to the shared folder."""
    pairs = stage(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stage(nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "wanted")
    # Named rows of a measured size spare the texts a shuffle; beyond it the join shuffles both sides.
    small = F.broadcast(wanted) if wanted.count() <= _BROADCAST_ROWS else wanted
    texts = docs.join(small, (docs["text_key"] == F.col("_key")) & docs["doc_id"].eqNullSafe(F.col("_id")))
    sets = stage(full_sets(texts, shingle).dropDuplicates(["node"]), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    near = pairs.join(left, "a").join(right, "b").withColumn("both", both).where(
        F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent)
    return stage(near.select("a", "b"), "links")


def _open_buckets(members: DataFrame, central: DataFrame | None = None) -> DataFrame:
    """Members (bucket, node, comp) of buckets that hold several components, with the bucket's hub:
    the most central member by ``central`` (node, score) if given, else one drawn by hash."""
    if central is None:
        hub = F.min(F.col("node").bitwiseXOR(F.col("bucket"))).bitwiseXOR(F.col("bucket"))
    else:
        members, hub = members.join(central, "node"), F.max_by("node", "score")
    mixed = members.groupBy("bucket").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub.alias("hub")).where("lo <> hi")
    return members.select("bucket", "node", "comp").join(mixed.select("bucket", "hub"), "bucket")


def _centrality(members: DataFrame) -> DataFrame:
    """node, score: how many nodes it meets, over all its buckets with company. The origin of a
    group of edited copies shares more bands with the others than these do among themselves."""
    company = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(company, "bucket").groupBy("node").agg(F.sum("n").alias("score"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_key, n_shingles, component_id (smallest id reachable)."""
    source = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    signed = stage(signatures(source, shingle, bands, rows), "signatures")
    some = signed.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n_shingles", "parity", "bands"))
    nodes = some.groupBy("set_key").agg(first.alias("r")).select("set_key", "r.*").drop("none")
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    comps = nodes.select("node", F.col("node").alias("comp"))
    links = None
    for turn in range(3):
        if turn < 2:
            keys = F.slice("bands", 1, FIRST_BANDS) if turn == 0 else F.col("bands")
            entries = nodes.join(comps, "node").select("node", "comp", F.explode(keys).alias("bucket"))
        else:  # only buckets that held several components before can do so now
            entries = met.select("node", "bucket").join(comps, "node")
        met = _open_buckets(entries, _centrality(entries) if turn == 0 else None)
        if turn:
            met = stage(met, "open-buckets")
        if turn < 2:
            hubs = comps.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
            pairs = met.join(hubs, "hub").where("comp <> hub_comp")
            pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            pairs = pairs.join(_facts(nodes, "a"), "a").join(_facts(nodes, "b"), "b").where(_possible(percent))
        else:  # what cannot be similar enough does not leave the join
            left = met.select("bucket", F.col("node").alias("a"), F.col("comp").alias("ca")).join(_facts(nodes, "a"), "a")
            right = met.select("bucket", F.col("node").alias("b"), F.col("comp").alias("cb")).join(_facts(nodes, "b"), "b")
            same = left["bucket"] == right["bucket"]
            pairs = left.join(right, same & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _possible(percent))
        pairs = pairs.select("a", "b", "na", "nb").distinct()
        found = _linked(pairs, nodes, source, shingle, percent)
        links = found if links is None else links.union(found)
        if found.isEmpty():
            continue
        linked = components(links)
        comps = stage(nodes.select("node").join(linked, "node", "left").select(
            "node", F.coalesce("comp", "node").alias("comp")), "components")
    ids = nodes.join(comps, "node")
    smallest = ids.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(smallest, "comp").select(F.col("set_key").alias("_set"), "component_id")
    out = signed.drop("bands", "parity").join(named, signed["set_key"] == named["_set"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", own.alias("component_id"))


def op9(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
