"""Variable-capacity best-fit packing of documents into training sequences.

Texts are counted in words, longer ones than the largest permitted length are cut into pieces, and
the pieces are dealt by hash into groups of a few thousand. A group is packed by falling length: a
piece goes into the open bin it fills best, else a new bin is opened, of the permitted length that
costs least per word it can still hold. Every bin is finally downsized to the shortest permitted
length that holds its contents. This is done once for each permitted length as the longest one that
may be opened, and the cheapest outcome stays, so the lengths are chosen jointly.

The cost of a sequence of length n is ``fixed + n + n * n / square``: a fixed part for each
sequence, a linear one, and a quadratic one as attention has it.

Defined cases: a null text is empty; an empty text takes no room (one row, bin_id and capacity
null); rows that repeat an id are packed each on its own; equal lengths are ordered by id. Empty
tables give empty results, other columns may have any names. Nothing is cut off or left out. Bins
depend on the ids and lengths alone, not on how the table is partitioned; a very long text is only
counted, and its pieces are dealt one by one.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.common import narrow
from jobmine.session import stage

CAPACITIES = (256, 512, 1024, 2048, 4096)
FIXED_COST = 128.0
SQUARE_COST = 8192.0
RUN_ROWS = 4_096  # copies of a row that are numbered together
GROUP_ROWS = 2_000
_SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    bare = F.btrim(text, F.lit(_SPACES))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("int")


def cost(length, fixed: float = FIXED_COST, square: float = SQUARE_COST):
    return fixed + length + length * length / square


def _fill(sizes: np.ndarray, permitted: list[int], price) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece (given by falling size), and the contents of each bin."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[tuple[int, int]] = []  # (free words, bin), sorted
    used: list[int] = []
    left = int(sizes.sum())
    for i, size in enumerate(sizes.tolist()):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, k = room.pop(at)
        else:
            fits = [c for c in permitted if c >= size]
            free = min(fits, key=lambda c: (price(c) / min(c, left), c))
            k = len(used)
            used.append(0)
        bins[i], offsets[i] = k, used[k]
        used[k] += size
        left -= size
        if free > size:
            insort(room, (free - size, k))
    return bins, offsets, used


def pack_sizes(sizes: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, fixed: float = FIXED_COST,
               square: float = SQUARE_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, final capacity of the bin) of each piece; sizes fall, none is above the largest capacity."""
    ordered = sorted(capacities)

    def price(length):
        return cost(length, fixed, square)

    best = None
    for longest in ordered:
        permitted = [c for c in ordered if c <= longest]
        if len(sizes) and longest < sizes[0]:
            continue
        bins, offsets, used = _fill(sizes, permitted, price)
        final = np.array([ordered[bisect_left(ordered, u)] for u in used], np.int64)
        total = float(price(final).sum())
        if best is None or total < best[0]:
            best = (total, bins, offsets, final)
    _, bins, offsets, final = best
    return bins, offsets, final[bins] if len(final) else bins


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
         capacities: tuple[int, ...] = CAPACITIES, fixed: float = FIXED_COST, square: float = SQUARE_COST,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """A row per piece: doc_id, piece, start, n_tokens, bin_id, bin_start, bin_tokens, capacity.

    ``length`` counts the words of the column ``text``; give another expression for other tokens.
    """
    largest = max(capacities)
    counted = narrow(docs, id_col, text_col).select(
        "doc_id", (word_count(F.col("text")) if length is None else length).cast("long").alias("n"))
    lengths = stage(counted, "lengths")
    # Rows of one id and length are interchangeable: counted and numbered again, a few at a time, they
    # get the same numbers however the table is partitioned.
    alike = lengths.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("copies"))
    runs = alike.select("doc_id", "n", "copies", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN_ROWS).cast("long"))).alias("low"))
    rows = runs.select("doc_id", "n", F.explode(
        F.sequence("low", F.least(F.col("low") + RUN_ROWS, F.col("copies")) - 1)).alias("row"))
    pieces = rows.select(
        "doc_id", "row", "n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)))).alias("piece"),
    ).withColumn("start", F.col("piece") * largest).withColumn(
        "n_tokens", F.least(F.col("n") - F.col("start"), F.lit(largest)))
    total = lengths.agg(F.sum(F.ceil(F.col("n") / largest))).first()[0] or 0
    groups = max(1, -(-int(total) // group_rows))
    group = F.pmod(F.xxhash64("doc_id", "n", "row", "piece"), F.lit(groups))
    dealt = pieces.where("n_tokens > 0").withColumn("grp", group)

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["n_tokens", "doc_id", "n", "row", "piece"], ascending=[False, True, True, True, True])
        sizes = rows["n_tokens"].to_numpy(np.int64)
        bins, offsets, final = pack_sizes(sizes, capacities, fixed, square)
        tokens = np.bincount(bins, sizes).astype(np.int64)[bins]
        rows = rows.assign(bin_id=(rows["grp"].to_numpy(np.int64) << 24) + bins, bin_start=offsets,
                           bin_tokens=tokens, capacity=final)
        return rows[["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_start", "bin_tokens", "capacity"]]

    longs = ("piece", "start", "n_tokens", "bin_id", "bin_start", "bin_tokens", "capacity")
    schema = T.StructType([dealt.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in longs]])
    packed = dealt.groupBy("grp").applyInPandas(fill, schema)
    none = F.lit(None).cast("long")
    empty = pieces.where("n_tokens <= 0").select(
        "doc_id", "piece", "start", "n_tokens", none.alias("bin_id"), none.alias("bin_start"),
        none.alias("bin_tokens"), none.alias("capacity"))
    return packed.unionByName(empty)


def op3(docs: DataFrame) -> DataFrame:
    return pack(docs)
