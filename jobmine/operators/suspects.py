"""A Bloom filter of repeated keys, as a column expression.

Most rows of a table have a key of their own. A filter of the repeated keys tells, inside the scan,
which rows are surely alone; only the others (repeated keys, and few that look like one) are joined
with what was found about their key. The filter is a row of at most ``MAX_WORDS`` numbers of 64 bits,
whatever the table: with more repeated keys than it can tell apart more rows are suspects, all of them
at worst, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.session import stage

PROBES = 4
BITS_PER_KEY = 16  # one row in 400 that is alone is a suspect
MIN_WORDS = 1 << 6
MAX_WORDS = 1 << 20  # 8 MB


def _bits(key: Column, words: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(probe)).bitwiseAND(F.lit(words * 64 - 1)) for probe in range(PROBES)]


def bloom_filter(repeated: DataFrame, key: str) -> tuple[DataFrame, int]:
    """One row with ``bits``, an array of ``words`` numbers. ``repeated`` has each key once and should
    be stored, as it is counted first."""
    keys = repeated.count()
    words = min(MAX_WORDS, max(MIN_WORDS, 1 << max(0, (keys * BITS_PER_KEY // 64)).bit_length()))
    set_bits = repeated.select(F.explode(F.array(*_bits(F.col(key), words))).alias("bit"))
    word = F.shiftright("bit", 6).cast("int").alias("word")
    mask = F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("mask")
    found = set_bits.groupBy(word).agg(mask)
    every = repeated.sparkSession.range(words).join(found, F.col("id") == F.col("word"), "left")
    placed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))))  # one per word
    return stage(every.agg(F.transform(placed, lambda cell: cell["mask"]).alias("bits")), "filter"), words


def may_hold(filter_row: DataFrame, words: int, key: Column) -> Column:
    """Whether the key may be one of the filter's; false means that it surely is not."""
    bits = filter_row.select("bits").scalar()
    test = F.lit(True)
    for bit in _bits(key, words):
        word = F.get(bits, F.shiftright(bit, 6).cast("int"))
        test = test & (F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return test
