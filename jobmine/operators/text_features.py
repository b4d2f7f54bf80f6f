"""N-grams, TF-IDF and truncated SVD.

Counts per document never leave the document's row: terms are counted inside the row, and only the
corpus totals per term are shuffled. The dense factors have a size fixed by the settings
(vocabulary times components), which is checked before they are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from jobmine.config import STOP_PHRASES, Settings
from jobmine.functions import vectors as V
from jobmine.functions.text import TOKEN, fold_accents
from jobmine.operators.ordered import sample_n
from jobmine.operators.suspects import bloom_filter, may_hold
from jobmine.session import limit_batches, small_batches, stage

MAX_FACTOR_BYTES = 512 * 1024 * 1024
PANEL_BYTES = 32 * 1024 * 1024
_BLOCK = 2_048  # terms whose rows are added up together
_CHUNK = 50_000
_PART = 400_000  # words whose n-grams are counted or looked up together
_CELLS = 1 << 17  # numbers of a gathered piece of a factor, which stays in the processor's cache
_HELD = 1 << 20  # hashes of n-grams a task adds up before it sends them
_SLOTS = 1 << 22  # slots for rough counts of n-grams, at most
_RUN = 1 << 15  # slots that are added up together
_FAN = 16  # triangles merged at a time
_NULL = 1e-10  # share of the largest squared singular value below which a direction is none


def stop_tokens(phrases: Sequence[str] = STOP_PHRASES) -> list[str]:
    """Phrases cut into words of two or more characters, unique and sorted."""
    return sorted({t for p in phrases for t in re.findall(r"\w\w+", p.lower())})


def tokens(col: Column, stop: Sequence[str] = (), fold: bool = False) -> Column:
    """Words of two or more characters without stop words; ``fold`` compares them unaccented."""
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN), F.lit(0))
    if not stop:
        return words
    kept = list(stop)
    return F.filter(words, lambda w: ~(fold_accents(w) if fold else w).isin(kept))


def _int_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``counts[i]`` numbers each, one after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(starts - before, counts)


def _slices(lists: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """The rows in slices of about ``most`` elements, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(lists):
        held = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, held + most, "right")))
        yield lists.slice(low, high - low)
        low = high


def _joined(lists: pa.ListArray, low: int, high: int) -> pa.ListArray:
    """The n-grams of each row's words, order by order."""
    words = lists.flatten()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    per_order = [np.maximum(sizes - (n - 1), 0) for n in range(low, high + 1)]
    ends = np.cumsum(np.sum(per_order, axis=0))
    place = ends - np.sum(per_order, axis=0)
    grams, made, picked, held = words, [], np.empty(ends[-1], np.int64), 0
    for n in range(1, high + 1):
        if n > 1:  # some of these reach into the next row; they are not picked
            grams = pc.binary_join_element_wise(grams[:-1], words[n - 1:], " ")
        if n >= low:
            counts = per_order[n - low]
            picked[_int_ranges(place, counts)] = held + _int_ranges(starts, counts)
            place = place + counts
            made.append(grams)
            held += len(grams)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(made).take(pa.array(picked)))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All n-grams of ``low`` to ``high`` words, joined by a blank. ``words`` is an array of words.

    Made from whole batches in Arrow, some rows at a time; the JVM builds such strings one by one.
    """
    @F.arrow_udf(ArrayType(StringType()))
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in _slices(batch, _CHUNK):
                yield _joined(part, low, high)

    return make(words)


def tokenize_ngrams(
    df: DataFrame, text: str, out: str = "grams", low: int = 1, high: int = 3,
    stop: Sequence[str] = (), fold: bool = False,
) -> DataFrame:
    """Append the n-grams of a text; stop words are removed before n-grams are made.

    The words stand beside them, in the column that the metadata of ``out`` names, so that steps which only
    count or look up n-grams need not make them. A column that is not read costs nothing.
    """
    words = f"_{out}_words"
    cut = df.withColumn(words, tokens(F.col(text), stop, fold))
    made = cut.withColumn(out, ngrams(F.col(words), low, high))
    return made.withMetadata(out, {"words": words, "low": low, "high": high})


def _made_of(df: DataFrame, grams: str) -> tuple[str, int, int] | None:
    """The column of words, the lowest and the highest order ``grams`` was made of, if it stands beside it."""
    known = df.schema[grams].metadata
    if known.get("words") not in df.columns or "low" not in known:
        return None
    return known["words"], known["low"], known["high"]


def ngram_counts(df: DataFrame, grams: str = "grams", id_col: str = "id") -> DataFrame:
    """``(id, gram, n)``: how often each n-gram occurs under an id.

    Counted inside the row. Only rows whose id may occur again (a Bloom filter of the repeated ids
    tells) are added up by id and n-gram, so with ids of their own no n-gram is shuffled.
    """
    @F.arrow_udf("array<struct<gram: string, n: bigint>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in _slices(batch, 4 * _CHUNK):
                strings, owners = _flat(part)
                codes, found = _coded(strings)
                cells, n = np.unique(owners * len(found) + codes, return_counts=True)
                at = np.searchsorted(cells, np.arange(len(part) + 1) * len(found))
                pairs = pa.StructArray.from_arrays(
                    [found.take(pa.array(cells % max(len(found), 1))), pa.array(n)], names=["gram", "n"])
                yield pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pairs)

    def counted(rows: DataFrame) -> DataFrame:
        return rows.select(id_col, F.inline_outer(count(grams))).where("gram IS NOT NULL")

    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sizes = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = stage(sizes.where("_rows > 1").select("_key"), "repeated-ids")
    if repeated.isEmpty():
        return counted(df)
    again = may_hold(*bloom_filter(repeated, "_key"), key)
    added = counted(df.where(again)).groupBy(id_col, "gram").agg(F.sum("n").alias("n"))
    return counted(df.where(~again)).unionByName(added)


def ngram_frequency(
    df: DataFrame, text: str, low: int, high: int, n: int = 20,
    sample: int | None = None, id_col: str = "id", seed: int = 42,
) -> DataFrame:
    """The n commonest n-grams, stop words included; on a fixed-size sample if asked for."""
    rows = df.select(id_col, text)
    if sample is not None:
        rows = sample_n(rows, sample, id_col, seed)
    grams = tokenize_ngrams(rows, text, "grams", low, high)
    return _commonest(grams, "grams", n, high).select("term", "tf").withColumnsRenamed(
        {"term": "ngram", "tf": "freq"}).orderBy(F.desc("freq"), "ngram").limit(n)


def _flat(lists: pa.ListArray) -> tuple[pa.StringArray, np.ndarray]:
    """The strings of all rows without nulls, and the row each belongs to."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    strings, owners = lists.flatten(), np.repeat(np.arange(len(lists)), sizes)
    if strings.null_count:
        held = strings.is_valid()
        strings, owners = strings.filter(held), owners[held.to_numpy(zero_copy_only=False)]
    return strings, owners


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each value, and the values by number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIXER = 0xD6E8FEB86659FD93
_GROUPS = {  # of long rows; by default a hundred wait before the size of their group is looked at
    "parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "compression": "zstd"}
_LETTERS = np.random.default_rng(2_024).integers(0, 1 << 64, 256, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _orders(strings: pa.StringArray) -> np.ndarray:
    """Words of each string."""
    return pc.count_substring(strings, " ").to_numpy(zero_copy_only=False).astype(np.int64) + 1


class _Hashes:
    """64-bit hashes of strings and of their parts, all from one running sum over their bytes."""

    def __init__(self, strings: pa.StringArray, powers: dict[int, np.ndarray]):
        """``powers`` keeps the powers of the base and its inverse for a task's next strings."""
        _, offsets, data = strings.buffers()
        if not len(strings):
            offsets, data = pa.py_buffer(bytes(4)), pa.py_buffer(b"")
        ends = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
        text = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        self.starts, self.ends = ends[:-1], ends[1:]
        for base in (_BASE, _INVERSE):
            if base not in powers or len(powers[base]) <= len(text):
                powers[base] = np.cumprod(np.append(np.uint64(1), np.full(2 * len(text), base, np.uint64)))
        self.inverse = powers[_INVERSE]
        self.sums = np.zeros(len(text) + 1, np.uint64)
        cells = self.sums[1:]
        np.take(_LETTERS, text, out=cells, mode="clip")
        np.multiply(cells, powers[_BASE][:len(text)], out=cells)
        np.cumsum(cells, out=cells)
        self.blanks = np.flatnonzero(text == 32)
        self.orders = _orders(strings)
        self.last = np.cumsum(self.orders - 1)
        self.first = self.last - (self.orders - 1)

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        own = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return _mixed(own + (ends - starts).astype(np.uint64)).view(np.int64)

    def every(self) -> np.ndarray:
        return self.between(self.starts, self.ends)

    def parts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes without the last and without the first word, of strings of two or more words."""
        head = self.between(self.starts[chosen], self.blanks[self.last[chosen] - 1])
        return head, self.between(self.blanks[self.first[chosen]] + 1, self.ends[chosen])


def _within(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``held``."""
    if not len(held):
        return np.zeros(len(values), bool)
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal hashes stand together, as they came, and where each kind starts."""
    order = np.argsort(hashes, kind="stable")
    return order, np.flatnonzero(np.diff(hashes[order], prepend=hashes[order[:1]] - 1))


def _row_counts(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per hash the first place, the occurrences and the rows it occurs in. ``owners`` ascend."""
    if not len(hashes):
        return (np.empty(0, np.int64),) * 3
    order, starts = _grouped(hashes)
    own = owners[order]
    fresh = np.append(True, own[1:] != own[:-1])
    fresh[starts] = True
    return order[starts], np.diff(starts, append=len(order)), np.add.reduceat(fresh.astype(np.int64), starts)


def _tally(kinds: np.ndarray, owners: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ``kinds``, their occurrences and the rows they occur in; ``kinds * rows`` fits 63 bits."""
    keys = np.sort(kinds * rows + owners)
    fresh = np.flatnonzero(np.diff(keys, prepend=-1))
    each = keys[fresh] // rows
    starts = np.flatnonzero(np.diff(each, prepend=-1))
    return each[starts], np.diff(fresh[starts], append=len(keys)), np.diff(starts, append=len(each))


class _Places:
    """Finds numbers in an array of different numbers by tables of slots: what loses its slot goes to the next table."""

    def __init__(self, held: np.ndarray):
        self.held, self.tables = held, []
        left, step = np.arange(len(held)), _BASE
        bits = max(4, (4 * len(held)).bit_length())
        while len(left):
            self.tables.append((np.uint64(step), np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)))
            slots = self._slots(held[left], *self.tables[-1][:2])
            table = self.tables[-1][2]
            table[slots] = left
            left, step = left[table[slots] != left], step * _MIXER % (1 << 64) | 1

    @staticmethod
    def _slots(values: np.ndarray, step: np.uint64, shift: np.uint64) -> np.ndarray:
        return ((values.view(np.uint64) * step) >> shift).view(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 if it is not held."""
        result, left = np.full(len(values), -1), None
        for step, shift, table in self.tables:
            asked = values if left is None else values[left]
            at = table[self._slots(asked, step, shift)]
            hit = (self.held[at] == asked) & (at >= 0)
            met = np.flatnonzero(hit)
            result[met if left is None else left[met]] = at[met]
            rest = np.flatnonzero(~hit & (at >= 0))  # only who met another in its slot may be in the next table
            left = rest if left is None else left[rest]
            if not len(left):
                break
        return result


class _Words:
    """Some rows' words by number, and the hashes of the n-grams they make, without making them."""

    def __init__(self, packed: dict[str, bytes], powers: dict[int, np.ndarray]):
        sizes, ends = (np.frombuffer(packed[name], np.int32) for name in ("sizes", "ends"))
        self.codes = np.frombuffer(packed["codes"], np.int32).astype(np.int64)
        self.found = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(packed["ends"]), pa.py_buffer(packed["words"]))
        self.rows = len(sizes)
        self.owners = np.repeat(np.arange(self.rows), sizes)
        self.own = _Hashes(self.found, powers).every().view(np.uint64)
        self.rolled = [self.own[self.codes]]

    @staticmethod
    def packed(lists: pa.ListArray) -> dict[str, list[bytes]]:
        """The rows that have words: their sizes, the numbers of their words, and the words one after the other."""
        strings, owners = _flat(lists)
        codes, found = _coded(strings)
        sizes = np.diff(np.flatnonzero(np.diff(owners, prepend=-1)), append=len(owners))
        ends = np.append(0, np.cumsum(pc.binary_length(found).to_numpy(zero_copy_only=False)))
        return {
            "sizes": [sizes.astype(np.int32).tobytes()], "codes": [codes.astype(np.int32).tobytes()],
            "ends": [ends.astype(np.int32).tobytes()], "words": ["".join(found.to_pylist()).encode()],
        }

    def starts(self, order: int) -> np.ndarray:
        """Where an n-gram starts that ends in the same row."""
        ends = self.owners[order - 1:]
        return np.flatnonzero(ends == self.owners[:len(ends)])

    def hashes(self, order: int) -> np.ndarray:
        """Of the n-gram that starts at each place, also of those that reach into the next row."""
        while len(self.rolled) < order:
            self.rolled.append(self.rolled[-1][:-1] * np.uint64(_BASE) + self.rolled[0][len(self.rolled):])
        return self.rolled[order - 1].view(np.int64)

    def load(self, order: int, slots: np.ndarray) -> None:
        """Add the n-grams of an order to the slots of their hashes."""
        if order == 1:
            np.add.at(slots, _slot(self.own, len(slots)), np.bincount(self.codes, minlength=len(self.own)))
        else:
            np.add.at(slots, _slot(self.hashes(order)[self.starts(order)], len(slots)), 1)

    def counts(self, order: int, heavy: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, occurrences and rows of each n-gram of an order whose slot is in ``heavy``; with ``words``,
        the slots of its words must be too."""
        at, width = self.starts(order), len(self.found)
        if order == 1 or words:
            held = heavy[_slot(self.own, len(heavy))][self.codes]
            for j in range(order):
                at = at[held[at + j]]
        if order > 1:
            at = at[heavy[_slot(self.hashes(order)[at], len(heavy))]]
        if order > 2:
            hashes, kinds = np.unique(self.hashes(order)[at], return_inverse=True)
        else:
            kinds = self.codes[at] if order == 1 else self.codes[at] * width + self.codes[at + 1]
        each, tf, df = _tally(kinds, self.owners[at], self.rows)
        if order > 2:
            return hashes[each], tf, df
        own = self.own[each] if order == 1 else self.own[each // width] * np.uint64(_BASE) + self.own[each % width]
        return own.view(np.int64), tf, df

    def longer(
        self, order: int, parts: _Places | None, heavy: np.ndarray
    ) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Hash, term, occurrences and rows of each n-gram of an order whose two parts are in ``parts`` and whose
        slot is in ``heavy``."""
        at, hashes, width = self.starts(order), self.hashes(order - 1), max(len(self.found), 1)
        places = None if parts is None else parts.find(hashes)
        if places is not None:
            at = at[(places[at] >= 0) & (places[at + 1] >= 0)]
        at = at[heavy[_slot(self.hashes(order)[at], len(heavy))]]
        if places is None:
            heads, kinds = np.unique(hashes[at], return_inverse=True)
            example = np.empty(len(heads), np.int64)
            example[kinds] = at
        else:
            example = np.full(len(parts.held), -1)
            example[places[at]] = at
            met = np.flatnonzero(example >= 0)
            number = np.empty(len(example), np.int64)
            number[met] = np.arange(len(met))
            kinds, example = number[places[at]], example[met]
        each, tf, df = _tally(kinds * width + self.codes[at + order - 1], self.owners[at], max(self.rows, 1))
        first, last = example[each // width], each % width
        own = hashes[first].view(np.uint64) * np.uint64(_BASE) + self.own[last]
        return own.view(np.int64), self.terms(first, order - 1, self.found.take(pa.array(last))), tf, df

    def terms(self, at: np.ndarray, order: int, *end: pa.Array) -> pa.Array:
        words = [self.found.take(pa.array(self.codes[at + j])) for j in range(order)]
        return pc.binary_join_element_wise(*words, *end, " ")


def _packed_words(df: DataFrame, words: str) -> tuple[DataFrame, int]:
    """The words of all rows for the passes over them, about ``_PART`` a row, see ``_Words``; and their number.

    Rows of some megabytes: few make a row group, and few wait for a task of a pass.
    """
    most = _PART

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch.column(0), most):
                packed = _Words.packed(part)
                yield pa.RecordBatch.from_pydict({**packed, "places": [len(packed["codes"][0]) // 4]})

    spark, schema = df.sparkSession, "sizes binary, codes binary, ends binary, words binary, places long"
    tasks = 4 * spark.sparkContext.defaultParallelism  # of each pass: few files are written, few sums are sent
    with small_batches(spark):
        packed = stage(df.select(words).coalesce(tasks).mapInArrow(pack, schema), "words", **_GROUPS)
    places = packed.agg(F.sum("places")).first()[0] or 0
    return packed.drop("places").coalesce(tasks), places


def _unpacked(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Buffer]]:
    """The buffers of each row of a batch of binary columns."""
    for row in range(batch.num_rows):
        yield {name: batch.column(name)[row].as_buffer() for name in batch.schema.names}


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each hash; ``slots`` is a power of two."""
    shift = np.uint64(65 - slots.bit_length())
    return ((hashes.view(np.uint64) * np.uint64(_MIXER)) >> shift).view(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers in compressed form, first bytes first, so that the empty high bytes shrink."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def _from_planes(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(packed, 8 * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view(np.int64).ravel()


def _loads(df: DataFrame, orders: Sequence[int], places: int) -> np.ndarray:
    """How many n-grams of the packed words fall into each slot: no n-gram occurs more often than its slot."""
    size = min(_SLOTS, max(1 << 12, 1 << (places // 8).bit_length()))
    run = min(size, _RUN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, powers = np.zeros(size, np.int64), {}
        for row in (row for batch in batches for row in _unpacked(batch)):
            words = _Words(row, powers)
            for order in orders:
                words.load(order, slots)
        for at in range(0, size if powers else 0, run):
            yield pa.RecordBatch.from_pydict({
                "run": pa.array([at // run], pa.int32()), "counts": [_planes(slots[at:at + run])]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(run, np.int64)
        for counts in frame["counts"]:
            total += _from_planes(counts, run)
        return pd.DataFrame({"run": frame["run"].iloc[:1], "counts": [_planes(total)]})

    schema, result = "run int, counts binary", np.zeros(size, np.int64)
    for row in df.mapInArrow(count, schema).groupBy("run").applyInPandas(add, schema).collect():
        result[row["run"] * run:(row["run"] + 1) * run] = _from_planes(row["counts"], run)
    return result


def _added(found: Iterator[list], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Batches of the found columns (hash, something the hash stands for, tf, df), equal hashes added up as far as
    ``_HELD`` of them may wait."""
    parts, waiting, merged_at = [], 0, _HELD // 2

    def merged() -> list:
        hashes, tf, df = (np.concatenate([part[k] for part in parts]) for k in (0, 2, 3))
        labels = pa.concat_arrays([part[1] for part in parts])
        order, starts = _grouped(hashes)
        first = order[starts]
        return [hashes[first], labels.take(pa.array(first)), *(np.add.reduceat(x[order], starts) for x in (tf, df))]

    def batches() -> Iterator[pa.RecordBatch]:
        columns = merged()
        for at in range(0, len(columns[0]), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(c[at:at + (1 << 17)]) for c in columns], names=names)

    for columns in found:
        if not len(columns[0]):
            continue
        parts.append(columns)
        waiting += len(columns[0])
        if waiting >= merged_at:
            parts = [merged()]
            waiting = len(parts[0][0])
            merged_at = 2 * waiting
            if waiting >= _HELD // 2:
                yield from batches()
                parts, waiting, merged_at = [], 0, _HELD // 2
    if parts:
        yield from batches()


def _hash_counts(
    df: DataFrame, grams: str, highest: int, orders: Sequence[int] | None = None, heavy: np.ndarray | None = None
) -> DataFrame:
    """``(hash, words, tf, df)`` of the n-grams of one or two words (and, with ``words`` 0, of those
    longer than ``highest``). A task adds up what it meets, ``_HELD`` hashes at most. With ``orders``, ``df``
    holds packed words, and of their n-grams those of the orders in ``heavy`` slots are counted."""
    shared = df.sparkSession.sparkContext.broadcast(None if heavy is None else np.packbits(heavy))

    def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        heavy, powers = np.unpackbits(shared.value).view(bool), {}
        for row in (row for batch in batches for row in _unpacked(batch)):
            words = _Words(row, powers)
            for order in orders:
                own, tf, df = words.counts(order, heavy, 1 in orders)
                yield [own, pa.array(np.full(len(own), 0 if order > highest else order, np.int32)), tf, df]

    def counted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        powers = {}
        for part in (part for batch in batches for part in _slices(batch.column(0), 2 * _CHUNK)):
            strings, owners = _flat(part)
            orders = _orders(strings)
            chosen = np.flatnonzero((orders <= min(2, highest)) | (orders > highest))
            orders = np.where(orders > highest, 0, orders)[chosen].astype(np.int32)
            own = _Hashes(strings.take(pa.array(chosen)), powers).every()
            first, tf, df = _row_counts(own, owners[chosen])
            yield [own[first], pa.array(orders[first]), tf, df]

    counted = counted_grams if orders is None else counted_words

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(counted(batches), ["hash", "words", "tf", "df"])

    rows = (df.select(grams) if orders is None else df).mapInArrow(add, "hash long, words int, tf long, df long")
    return rows.groupBy("hash").agg(F.max("words").alias("words"), F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _level(
    df: DataFrame, grams: str, order: int, parts: np.ndarray | None, named: np.ndarray,
    made: tuple[int, int] | None = None, heavy: np.ndarray | None = None,
) -> DataFrame:
    """``(hash, term, tf, df)`` of the n-grams of ``order`` words whose two parts are in ``parts``
    (None: of all); and the terms of the hashes in ``named``, without counts, once a task at least.
    ``made`` are the lowest and highest order if ``df`` holds packed words; of their n-grams those in
    ``heavy`` slots are counted."""
    shared = df.sparkSession.sparkContext.broadcast((parts, named, None if heavy is None else np.packbits(heavy)))

    def batch_of(hashes, terms, tf, df) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes), terms, pa.array(tf), pa.array(df)], names=["hash", "term", "tf", "df"])

    def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        parts, named, heavy = shared.value
        seen, powers = np.zeros(len(named), bool), {}
        parts, named = None if parts is None else _Places(parts), _Places(named)
        heavy = np.unpackbits(heavy).view(bool)
        for row in (row for batch in batches for row in _unpacked(batch)):
            words = _Words(row, powers)
            if made[0] <= order <= made[1]:
                yield [*words.longer(order, parts, heavy)]
            for length in range(made[0], made[1] + 1) if not seen.all() else ():
                at = words.starts(length)
                hashes = words.hashes(length)[at]
                places = named.find(hashes)
                met = np.flatnonzero(places >= 0)
                met = met[~seen[places[met]]]
                fresh = met[np.unique(places[met], return_index=True)[1]]
                seen[places[fresh]] = True
                none = np.zeros(len(fresh), np.int64)
                yield [hashes[fresh], words.terms(at[fresh], length), none, none]

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(counted_words(batches), ["hash", "term", "tf", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, named, _ = shared.value
        seen, powers = np.zeros(len(named), bool), {}
        for batch in batches:
            for part in _slices(batch.column(0), 2 * _CHUNK):
                strings, owners = _flat(part)
                hashes = _Hashes(strings, powers)
                own = hashes.every()
                longer = np.flatnonzero(hashes.orders == order) if order else np.empty(0, np.int64)
                if parts is not None and len(longer):
                    for held in range(2):
                        longer = longer[_within(hashes.parts(longer)[held], parts)]
                first, tf, df = _row_counts(own[longer], owners[longer])
                met = np.flatnonzero(_within(own, named))
                places = np.searchsorted(named, own[met])
                met, places = met[~seen[places]], places[~seen[places]]
                fresh = met[np.unique(places, return_index=True)[1]]
                seen[places] = True
                none, chosen = np.zeros(len(fresh), np.int64), np.concatenate([longer[first], fresh])
                yield batch_of(
                    own[chosen], strings.take(pa.array(chosen)), np.concatenate([tf, none]), np.concatenate([df, none]))

    rows = (df if made else df.select(grams)).mapInArrow(
        add_words if made else add, "hash long, term string, tf long, df long")
    return rows.groupBy("hash", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _hashes_of(rows: DataFrame) -> np.ndarray:
    return np.sort(rows.select("hash").toPandas()["hash"].to_numpy(np.int64))


def _commonest(
    df: DataFrame, grams: str, size: int, highest: int, min_df: int = 0, max_df: float | None = None
) -> DataFrame:
    """``(term, tf, df)`` of the ``size`` commonest terms in ``min_df`` to ``max_df`` rows, and of a few more.

    N-grams of one and two words are counted by their 64-bit hashes. An n-gram is no more frequent
    than either of the two shorter ones it starts and ends with, so of the longer ones only those are
    counted whose parts occur as often as the last of the ``size`` commonest found so far; the same
    pass over the texts finds the terms of the hashes that are left. If the words stand beside the
    n-grams, they are stored once in packed form for all passes. The first of these adds up n-grams by
    slots of a table of fixed size, so that the others count only those whose slot is heavy enough.
    """
    source = _made_of(df, grams)
    made, floor = source and source[1:], max(min_df, 1)
    if source:
        df, places = _packed_words(df, source[0])
        loads, wanted = _loads(df, range(made[0], made[1] + 1), places), 2 * size + 100
        start = floor if wanted > len(loads) else max(floor, int(np.partition(loads, -wanted)[-wanted]))

    def eligible(rows: DataFrame) -> DataFrame:
        within = F.col("df") >= min_df
        return rows.where(within if max_df is None else within & (F.col("df") <= max_df))

    def least(*tables: DataFrame) -> int:
        """The count of the last of the commonest, 0 if there are not as many."""
        every = reduce(DataFrame.unionAll, [eligible(t).select("tf") for t in tables])
        last = every.orderBy(F.desc("tf")).limit(size).agg(F.count(F.lit(1)), F.min("tf")).first()
        return last[1] if last[0] == size and size else 0

    def heaviest(count: Callable[[np.ndarray], DataFrame], *before: DataFrame) -> DataFrame:
        """What ``count`` finds in more of the heaviest slots than there are terms to find; if the last of the
        commonest is rarer than these slots are heavy, what it finds in all slots as heavy as that."""
        found = count(loads >= start)
        last = max(floor, least(*before, found.where("tf > 0")))
        return found if last >= start else count(loads >= last)

    def grams_in(heavy: np.ndarray | None = None) -> DataFrame:
        return stage(_hash_counts(df, grams, highest, orders, heavy), "gram-counts")

    orders = made and [n for n in range(made[0], made[1] + 1) if n <= min(2, highest) or n > highest]
    counts = heaviest(grams_in) if orders else grams_in(made and loads >= start)
    bound = least(counts)
    kept = counts.where((F.col("df") >= min_df) & (F.col("tf") >= bound))
    named = _hashes_of(eligible(kept))
    last_order = min(2, highest)
    known = made[0] <= last_order if made else not counts.where(F.col("words") == last_order).isEmpty()
    parts = _hashes_of(kept.where(F.col("words") == last_order)) if known else None
    found, terms = [], None
    for order in [*range(3, highest + 1)] or [0]:
        def level_in(heavy: np.ndarray | None = None) -> DataFrame:
            return stage(_level(df, grams, order, parts, named if terms is None else named[:0], made, heavy), "terms")

        if made and not bound and not orders:
            level = heaviest(level_in, counts, *found[1:])
        else:
            level = level_in(made and loads >= max(bound, floor))
        if terms is None:
            terms = level.where("tf = 0").select("hash", "term")
            found.append(eligible(kept).join(terms, "hash").select("term", "tf", "df"))
        level = level.where("tf > 0")
        found.append(eligible(level).select("term", "tf", "df"))
        if order < highest and order:
            bound = least(counts, *found[1:])
            known = known or not level.isEmpty()
            held = level.where((F.col("df") >= min_df) & (F.col("tf") >= bound))
            parts = _hashes_of(held) if known else None
    return reduce(DataFrame.unionAll, found)


def select_vocabulary(
    df: DataFrame, grams: str = "grams", settings: Settings = Settings()
) -> DataFrame:
    """Terms in ``min_df`` rows to a ``max_df`` share of rows, the most frequent first.

    ``grams`` holds the n-grams of a row from some order upwards, as ``tokenize_ngrams`` makes them.
    """
    n_docs = df.count()
    size, highest = settings.vocabulary_size, settings.ngram_max
    counts = _commonest(df, grams, size, highest, settings.min_df, n_docs * settings.max_df)
    kept = counts.withColumn("n_docs", F.lit(n_docs)).orderBy(F.desc("tf"), "term").limit(size)
    # At most vocabulary_size rows from here on.
    return kept.withColumns({
        "term_idx": F.row_number().over(Window.orderBy("term")) - 1,
        "idf": F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1,
    })


@dataclass(frozen=True)
class TfidfModel:
    """Vocabulary in term order and its weights; at most ``vocabulary_size`` entries."""

    terms: list[str]
    idf: list[float]

    @classmethod
    def fit(cls, df: DataFrame, grams: str = "grams", settings: Settings = Settings()) -> TfidfModel:
        rows = select_vocabulary(df, grams, settings).select("term", "idf").collect()
        rows.sort(key=lambda r: r["term"])
        return cls([r["term"] for r in rows], [r["idf"] for r in rows])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf, strict=True))]
        return spark.createDataFrame(rows, "term_idx int, term string, idf double")

    @classmethod
    def from_table(cls, table: DataFrame) -> TfidfModel:
        rows = sorted(table.collect(), key=lambda r: r["term_idx"])
        return cls([r["term"] for r in rows], [r["idf"] for r in rows])


def _trie(terms: Sequence[str]) -> tuple[pa.Array, list[np.ndarray], list[np.ndarray]]:
    """The terms of a vocabulary word by word: its words, the steps from a node and a word to the nodes of the
    next depth, and the term that ends at each node of a depth, -1 if none does. Nodes of depth one are words."""
    numbers: dict[str, int] = {}
    nodes: list[dict[tuple[int, int], int]] = []
    ends: list[dict[int, int]] = []
    for index, term in enumerate(terms):
        node = -1
        for depth, word in enumerate(term.split(" ")):
            number = numbers.setdefault(word, len(numbers))
            if depth == len(nodes):
                nodes.append({})
                ends.append({})
            node = nodes[depth].setdefault((node, number), len(nodes[depth])) if depth else number
        ends[depth].setdefault(node, index)
    steps = [np.array([node * len(numbers) + n for node, n in held], np.int64) for held in nodes[1:]]
    ended = []
    for depth, held in enumerate(ends):
        ended.append(np.full(len(nodes[depth]) if depth else len(numbers), -1))
        ended[-1][list(held)] = list(held.values())
    return pa.array(list(numbers), pa.string()), steps, ended


def _terms_within(
    lists: pa.ListArray, words: pa.Array, steps: Sequence[_Places], ended: Sequence[np.ndarray], low: int, high: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row and term of each n-gram of ``low`` to ``high`` of the rows' words that is a term of the trie."""
    strings, owners = _flat(lists)
    codes, found = _coded(strings)
    known = pc.fill_null(pc.index_in(found, value_set=words), -1).to_numpy(zero_copy_only=False)
    numbers = known.astype(np.int64)[codes]
    at = np.flatnonzero(numbers >= 0)
    node, rows, terms = numbers[at], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for depth in range(1, min(high, len(ended)) + 1):
        if depth > 1:
            inside = at + depth - 1 < len(numbers)
            at, node = at[inside], node[inside]
            last = at + depth - 1
            inside = (owners[last] == owners[at]) & (numbers[last] >= 0)
            at, node = at[inside], node[inside]
            node = steps[depth - 2].find(node * len(words) + numbers[last[inside]])
            at, node = at[node >= 0], node[node >= 0]
        if depth >= low:
            term = ended[depth - 1][node]
            rows.append(owners[at[term >= 0]])
            terms.append(term[term >= 0])
    return np.concatenate(rows), np.concatenate(terms)


def tfidf_transform(
    df: DataFrame, model: TfidfModel, grams: str = "grams", keep: Sequence[str] = ("id",)
) -> DataFrame:
    """Per row the term indices and unit-length weights ``(1 + ln tf) * idf``. No shuffle.

    Terms outside the vocabulary are dropped; a row without known terms has empty arrays.
    """
    if not model.terms:
        empty = F.array().cast("array<int>"), F.array().cast("array<double>")
        return df.select(*keep, empty[0].alias("term_idx"), empty[1].alias("weight"))
    limit_batches(df.sparkSession)
    source, most = _made_of(df, grams), _PART
    terms = _trie(model.terms) if source else pa.array(model.terms, pa.string())
    shared = df.sparkSession.sparkContext.broadcast((terms, np.array(model.idf)))

    @F.arrow_udf("struct<term_idx: array<int>, weight: array<double>>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, idf = shared.value
        size = len(idf)
        if source:
            words, ended = terms[0], terms[2]
            steps = [_Places(step) for step in terms[1]]
        for batch in batches:
            for part in _slices(batch, most if source else 20 * _CHUNK):
                if source:
                    owners, found = _terms_within(part, words, steps, ended, source[1], source[2])
                else:
                    strings, owners = _flat(part)
                    found = pc.fill_null(pc.index_in(strings, value_set=terms), -1).to_numpy(zero_copy_only=False)
                    owners, found = owners[found >= 0], found[found >= 0]
                cells, tf = np.unique(owners * size + found, return_counts=True)
                rows, index = cells // size, cells % size
                raw = (1 + np.log(tf)) * idf[index]
                norm = np.sqrt(np.bincount(rows, raw * raw, len(part)))
                at = pa.array(np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32))
                yield pa.StructArray.from_arrays([
                    pa.ListArray.from_arrays(at, pa.array(index.astype(np.int32))),
                    pa.ListArray.from_arrays(at, pa.array(raw / norm[rows])),
                ], names=["term_idx", "weight"])

    return df.select(*keep, weigh(source[0] if source else grams).alias("_cells")).select(*keep, "_cells.term_idx", "_cells.weight")


def weights_long(weights: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per document and term."""
    keep = [c for c in weights.columns if c not in ("term_idx", "weight")]
    zipped = F.arrays_zip("term_idx", "weight")
    return weights.select(*keep, F.inline_outer(zipped)).where("term_idx IS NOT NULL")


def matrix_density(weights: DataFrame, n_terms: int) -> DataFrame:
    """Rows, columns, stored weights and their share."""
    cells = F.col("rows") * F.col("columns")
    return weights.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("weight")), F.lit(0)).alias("nnz")
    ).withColumn("columns", F.lit(n_terms).cast("long")).withColumn("density", F.col("nnz") / cells)


def _row_products(lists: pa.ListArray, values: pa.ListArray, factor: np.ndarray) -> np.ndarray:
    """Sparse rows times ``factor`` of a batch of rows."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    terms = lists.flatten().to_numpy(zero_copy_only=False)
    weights = values.flatten().to_numpy(zero_copy_only=False)
    return _products(sizes, terms, weights, factor)[1]


def _products(
    sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, factor: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The row of each weight, and sparse rows times ``factor``."""
    product = np.zeros((len(sizes), factor.shape[1]))
    owners = np.repeat(np.arange(len(sizes)), sizes)
    _add_gathered(product, owners, factor, terms, weights, _CHUNK)
    return owners, product


def _add_gathered(
    result: np.ndarray, to: np.ndarray, rows: np.ndarray, picked: np.ndarray, values: np.ndarray, most: int
) -> None:
    """Add ``values`` times the ``picked`` rows to the rows ``to`` of the result; ``to`` ascends. At most
    ``most`` rows are gathered at a time, and so few that they stay in the processor's cache."""
    step = max(1, min(most, _CELLS // max(rows.shape[1], 1)))
    held = np.empty((min(step, len(to)), rows.shape[1]))
    for a in range(0, len(to), step):
        b = min(a + step, len(to))
        piece = held[:b - a]
        np.take(rows, picked[a:b], axis=0, out=piece, mode="clip")
        np.multiply(piece, values[a:b, None], out=piece)
        first = np.flatnonzero(np.diff(to[a:b], prepend=-1))
        result[to[a:b][first]] += np.add.reduceat(piece, first, axis=0)


def _packed_weights(weights: DataFrame) -> DataFrame:
    """The rows that have weights for the passes over them, about ``_PART`` weights in one row of the result."""
    most = _PART

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for part in _slices(batch.column(0), most):
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                values = batch.column(1).slice(low, len(part)).flatten().to_numpy(zero_copy_only=False)
                low += len(part)
                if len(values):
                    yield pa.RecordBatch.from_pydict({
                        "sizes": [sizes[sizes > 0].astype(np.int32).tobytes()],
                        "terms": [part.flatten().to_numpy(zero_copy_only=False).tobytes()], "values": [values.tobytes()],
                    })

    packed = weights.select("term_idx", "weight").mapInArrow(pack, "sizes binary, terms binary, values binary")
    with small_batches(weights.sparkSession):
        return stage(packed, "packed", **_GROUPS)


def _gram_times(weights: DataFrame, panels: Sequence[np.ndarray]) -> DataFrame:
    """``A'A basis`` for the packed document-term matrix ``A`` and its triangles, in blocks of terms.

    ``basis`` comes in panels of columns, each small enough for a task; a task adds up the blocks of
    terms it meets, so its memory depends on the panel alone. Returns ``(block, product, triangle)``:
    the block's rows and the R of their QR decomposition, both as bytes.
    """
    context = weights.sparkSession.sparkContext
    rows = weights.coalesce(2 * context.defaultParallelism)  # each sends sums as large as the basis
    size, chunk, n_terms = _BLOCK, _CHUNK, len(panels[0])

    def adder(number: int, shared):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            factor = shared.value
            sums: dict[int, np.ndarray] = {}
            for held in (row for batch in batches for row in _unpacked(batch)):
                sizes, terms = (np.frombuffer(held[name], np.int32) for name in ("sizes", "terms"))
                values = np.frombuffer(held["values"], np.float64)
                owners, product = _products(sizes, terms, values, factor)
                # Sorted numbers of term and place: several times as fast as an order of the terms.
                order = np.sort((terms.astype(np.int64) << 32) + np.arange(len(terms)))
                ordered, order = order >> 32, order & 0xFFFFFFFF
                owners, values = owners[order], values[order]
                cuts = np.flatnonzero(np.diff(ordered // size, prepend=-1))
                for low, high in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                    block = int(ordered[low]) // size
                    if block not in sums:
                        height = min(size, n_terms - block * size)
                        sums[block] = np.zeros((height, factor.shape[1]))
                    part = slice(low, high)
                    _add_gathered(sums[block], ordered[part] - block * size, product, owners[part], values[part], chunk)
            for block, total in sums.items():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int32()),
                    "panel": pa.array([number], pa.int32()),
                    "values": pa.array([total.ravel()], pa.list_(pa.float64())),
                })

        return add

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                height = min(size, n_terms - block * size)
                parts = batch.column("parts")[row].values.field("values")
                whole = np.hstack([part.values.to_numpy().reshape(height, -1) for part in parts])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int32()),
                    "product": pa.array([whole.tobytes()], pa.binary()),
                    "triangle": pa.array([np.linalg.qr(whole, mode="r").tobytes()], pa.binary()),
                })

    shared = [context.broadcast(panel) for panel in panels]
    partials = [
        rows.mapInArrow(adder(number, panel), "block int, panel int, values array<double>")
        for number, panel in enumerate(shared)
    ]
    summed = reduce(DataFrame.unionAll, partials).groupBy("block", "panel").agg(
        vector_to_array(Summarizer.sum(array_to_vector("values"))).alias("values")
    )
    # All panels of one block: its rows times the width of the basis.
    whole = summed.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("panel", "values"))).alias("parts")
    )
    found = stage(whole.mapInArrow(decompose, "block int, product binary, triangle binary"), "gram")
    for panel in shared:
        panel.unpersist()
    return found


def _triangle(blocks: DataFrame, n_blocks: int, width: int) -> np.ndarray:
    """R of the QR decomposition of all rows: triangles are stacked and decomposed in a tree, a few
    at a time, until a few are left for the driver."""
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(t).reshape(-1, width) for t in frame["triangle"]])
        merged = np.linalg.qr(stacked, mode="r").tobytes()
        return pd.DataFrame({"block": frame["block"].iloc[:1] // fan, "triangle": [merged]})

    fan, level = _FAN, blocks.select("block", "triangle")
    while n_blocks > fan:
        parent = F.floor(F.col("block") / fan)
        level = level.groupBy(parent).applyInPandas(merge, "block int, triangle binary")
        n_blocks = -(-n_blocks // fan)
    rest = [np.frombuffer(r["triangle"]).reshape(-1, width) for r in level.orderBy("block").collect()]
    return np.linalg.qr(np.vstack([np.zeros((width, width)), *rest]), mode="r")


def _turned(blocks: DataFrame, turn: np.ndarray, n_terms: int) -> np.ndarray:
    """All rows times ``turn``. The caller checks the size of the result."""
    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                (np.frombuffer(p.as_py()).reshape(-1, len(turn)) @ turn).tobytes()
                for p in batch.column("product")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array(made, pa.binary())], names=["block", "rows"]
            )

    result = np.zeros((n_terms, turn.shape[1]))
    turned = blocks.select("block", "product").mapInArrow(times, "block int, rows binary")
    for row in turned.toLocalIterator():
        found = np.frombuffer(row["rows"]).reshape(-1, turn.shape[1])
        start = row["block"] * _BLOCK
        result[start:start + len(found)] = found
    return result


def svd_fit(
    weights: DataFrame, n_terms: int, n_rows: int, components: int = 300,
    passes: int = 5, oversample: int = 10, seed: int = 42,
) -> np.ndarray:
    """Right factor (terms by components) of an uncentred truncated SVD.

    Subspace iteration with ``passes`` + 1 jobs over the documents. The product with the basis is
    kept as a table of term blocks; a tall-skinny QR merges the blocks' triangles in a tree, and the
    SVD of the last triangle turns the blocks into the next basis, which reaches the tasks in panels
    of columns of ``PANEL_BYTES`` at most. More terms than fit a panel of one column are refused.
    The weights are stored once in packed form, which is what the passes read, once per panel.

    The number of components is at most one less than rows or terms; those beyond the rank (a
    singular value under a hundred-thousandth of the largest) are zero. Signs are fixed: each
    component's largest loading is positive.
    """
    k = max(1, min(components, n_terms - 1, n_rows - 1))
    width = min(k + oversample, n_terms)
    step = PANEL_BYTES // (8 * n_terms)
    if n_terms * k * 8 > MAX_FACTOR_BYTES or not step:
        raise ValueError(f"a {n_terms} by {k} factor is too large to broadcast")
    cuts = [(a, min(a + step, width)) for a in range(0, width, step)]

    def start(low: int, high: int) -> np.ndarray:
        columns = [np.random.default_rng([seed, c]).normal(size=n_terms) for c in range(low, high)]
        return np.stack(columns, axis=1)

    panels, weights = (start(low, high) for low, high in cuts), _packed_weights(weights)
    for left in range(passes, -1, -1):
        blocks = _gram_times(weights, list(panels))
        _, values, right = np.linalg.svd(_triangle(blocks, -(-n_terms // _BLOCK), width))
        held = values > _NULL * values[0]
        turn = right.T * np.where(held, 1 / np.where(held, values, 1), 0)
        if left:
            panels = (_turned(blocks, turn[:, low:high], n_terms) for low, high in cuts)
    factor = _turned(blocks, turn[:, :k], n_terms)
    strongest = np.abs(factor).argmax(axis=0)
    return factor * np.sign(factor[strongest, np.arange(k)])


def svd_transform(weights: DataFrame, factor: np.ndarray, out: str = "features") -> DataFrame:
    """Replace the term weights by their projection on the components. Narrow; the factor is
    broadcast and only the two weight arrays are sent to Python."""
    if factor.nbytes > MAX_FACTOR_BYTES:
        raise ValueError("the factor is too large to broadcast")
    limit_batches(weights.sparkSession)
    shared = weights.sparkSession.sparkContext.broadcast(factor)

    @F.arrow_udf(ArrayType(DoubleType()))
    def project(lists: pa.Array, values: pa.Array) -> pa.Array:
        product = _row_products(lists, values, shared.value)
        offsets = np.arange(0, product.size + 1, product.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(product.ravel()))

    return weights.withColumn(out, project("term_idx", "weight")).drop("term_idx", "weight")


def factor_table(spark: SparkSession, factor: np.ndarray) -> DataFrame:
    """The right factor as one row per term, to store it."""
    return spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(factor)], "term_idx int, loadings array<double>"
    )


def factor_from_table(table: DataFrame) -> np.ndarray:
    return np.array([r["loadings"] for r in sorted(table.collect(), key=lambda r: r["term_idx"])])


def singular_values(features: DataFrame, col: str = "features") -> DataFrame:
    """(component, singular_value): the length of each column of the projected rows."""
    lengths = features.agg(vector_to_array(Summarizer.normL2(array_to_vector(F.col(col)))).alias("v"))
    return lengths.select(F.posexplode("v").alias("pos", "singular_value")).select(
        (F.col("pos") + 1).alias("component"), "singular_value"
    )


def svd_variance(
    features: DataFrame, weights: DataFrame, col: str = "features", n_rows: int | None = None
) -> DataFrame:
    """Share of the total variance held by each component, and the running share."""
    n = n_rows or features.count()
    spread = Summarizer.metrics("variance").summary(array_to_vector(F.col(col)))
    unbiased = features.agg(vector_to_array(spread["variance"]).alias("v"))
    held = unbiased.select(F.posexplode("v").alias("pos", "v")).select(
        (F.col("pos") + 1).alias("component"), (F.col("v") * (n - 1) / n).alias("variance")
    )
    # A term absent from a row counts as zero.
    per_term = weights_long(weights).groupBy("term_idx").agg(
        F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("s2")
    )
    total = per_term.agg(F.sum(F.col("s2") / n - (F.col("s") / n) * (F.col("s") / n))).scalar()
    ratio = held.select("component", (F.col("variance") / total).alias("explained_variance_ratio"))
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return ratio.withColumn(  # one row per component
        "cumulative_explained_variance", F.sum("explained_variance_ratio").over(upto)
    )


def l2_normalize(df: DataFrame, col: str = "features") -> DataFrame:
    return (
        df.withColumn("_norm", V.norm(F.col(col)))
        .withColumn(col, V.l2_normalize(F.col(col), F.col("_norm")))
        .drop("_norm")
    )


def drop_first_component(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn(col, V.drop_first(F.col(col)))


def low_dimensional(
    df: DataFrame, width: int = 10, drop_first: bool = False, col: str = "features"
) -> DataFrame:
    """The leading components as unit vectors: the small space clusters are found in."""
    base = drop_first_component(df, col) if drop_first else df
    return l2_normalize(base.withColumn(col, F.slice(F.col(col), 1, width)), col)


def feature_summary(spark: SparkSession, metrics: dict[str, object], split: DataFrame | None = None) -> DataFrame:
    """(metric, value) rows: shapes and settings, plus the outlier share per split."""
    fixed = spark.createDataFrame(
        [(k, float(v)) for k, v in metrics.items()], "metric string, value double"
    )
    if split is None:
        return fixed
    shares = split.groupBy("split").agg(
        F.avg(F.col("is_salary_outlier").cast("int")).alias("share"),
        F.count(F.lit(1)).cast("double").alias("rows"),
    ).select(F.inline(F.array(
        F.struct(F.concat(F.lit("salary_outlier_ratio_"), "split").alias("metric"), F.col("share").alias("value")),
        F.struct(F.concat("split", F.lit("_rows")), F.col("rows")),
    )))
    return fixed.unionByName(shares)
