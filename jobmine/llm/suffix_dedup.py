"""Removal of repeated passages by a logarithmic family of suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is removed. Only sampled
suffixes are indexed: each window of ``LENGTH`` bytes names the place in it whose ``LEAD`` bytes have
the smallest hash, so equal windows name the same place and every repeat shares a sampled suffix.
About one suffix in 35 bytes is sampled.

- Texts are kept as chunks of a few megabytes. A batch of chunks gets suffix arrays: its sampled
  suffixes, per bucket, in the order of the fingerprints of their leading bytes.
- A batch is merge-scanned against every level of the index, bucket by bucket; suffixes whose lead
  occurs more than once are reported to the chunks that hold them.
- The batch becomes a level; two levels of one size are merged to one of twice the size, so there
  are never more levels than the logarithm of the number of batches.
- Reported suffixes are compared in full: the windows around them meet by suffix, equal windows are
  found, and all but the earliest mark their bytes. Equal surroundings within a chunk are sent once.
- Suffixes with many different surroundings are counted first. Their windows are dealt singly, by
  the hash of their bytes, equal ones within a chunk once, so no task gets all of one suffix.

Texts that equal the text of an earlier document are found by digest first and removed whole, so
large groups of copies are not indexed. Strings are compared by two 64-bit hashes.

Defined cases: a null text is empty; texts shorter than the length lose nothing. Documents are
ordered by id, null first, then by digest; rows that repeat an id and a text are one document and
get one result each. Empty tables give empty results. Other columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import mix, slices, span_hashes
from jobmine.llm.common import narrow, small_batches
from jobmine.llm.katz import pack, pack_sorted, unpack, unpack_sorted
from jobmine.session import stage

LENGTH, LEAD = 100, 32
# A chunk meets nearly every bucket with a row of its own, and there are buckets in proportion to the bytes, so
# chunks are as large as a task can hold, but a small table is dealt to some dozens.
CHUNK_BYTES, LEAST_CHUNK, CHUNKS = 16 << 20, 1 << 20, 96
READ_ROWS = 4
_GROUPS = {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1}  # else a hundred rows wait
BLOCK_BYTES = 1 << 17
BATCHES = 3
BUCKET_ITEMS = 1 << 19
BUCKET_WINDOWS = 1 << 21
BLOCK_WINDOWS = 1 << 17
# A cell of suffixes with more windows is dealt window by window, to groups of about DEALT_WINDOWS.
HOT_WINDOWS = 1 << 17
DEALT_WINDOWS = 1 << 20
CELLS = 64
_PLACE_BITS = 28
_BROADCAST_ROWS = 200_000
_U = np.uint64


def sampled(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, lead: int = LEAD):
    """(fingerprint, first window, last window) of each run of windows that name one suffix.

    Windows do not cross the bounds of texts; blocks of a fixed size bound the memory.
    """
    span = length - lead + 1
    out = []
    for at in range(0, max(len(data) - length + 1, 0), BLOCK_BYTES):
        part = data[at:at + BLOCK_BYTES + length - 1]
        windows = len(part) - length + 1
        starts = np.arange(len(part) - lead + 1)
        prints = span_hashes(part, starts, starts + lead)
        least = (prints & ~_U((1 << _PLACE_BITS) - 1)) | starts.astype(np.uint64)
        done = 1
        while done < span:  # least[i] is the least of the next `done` places
            step = min(done, span - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        place = (least[:windows] & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        window = np.arange(windows)
        end = bounds[np.searchsorted(bounds, window + at, "right")]
        valid = window + at + length <= end
        window, place = window[valid], place[valid]
        if not len(window):
            continue
        fresh = np.ones(len(window), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(window)) - 1
        # Mixed, because least values crowd at the low end and buckets are ranges of fingerprints.
        out.append((mix(prints[place[first]]), window[first] + at, window[last] + at))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def chunks(docs: DataFrame, size: int) -> DataFrame:
    """One row per chunk of texts; ``docs`` has doc (the order of documents) and text."""

    def gather(batches):
        number = TaskContext.get().partitionId() << 32
        docs_in, parts, counts, held = [], [], [], 0

        def close():
            data = np.concatenate(parts)
            row = [number, pack(np.concatenate(docs_in)), pack(np.cumsum(np.concatenate(counts))), pack(data), len(data)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["chunk", "docs", "ends", "data", "n_bytes"])

        for batch in batches:
            for a, b, data, bounds in slices(batch.column(1)):
                docs_in.append(np.asarray(batch.column(0).slice(a, b - a)).astype(np.int64))
                parts.append(data)
                counts.append(np.diff(bounds))
                held += len(data)
                if held >= size:
                    yield close()
                    number += 1
                    docs_in, parts, counts, held = [], [], [], 0
        if docs_in:
            yield close()

    return docs.select("doc", "text").mapInArrow(
        gather, "chunk bigint, docs binary, ends binary, data binary, n_bytes bigint")


def _opened(row):
    ends = unpack(row.ends, np.int64)
    return unpack(row.docs, np.int64), np.concatenate([[0], ends]), unpack(row.data, np.uint8)


def _by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _suffix_arrays(buckets: int, length: int, lead: int):
    """Per chunk and bucket: sorted fingerprints, and whether each occurs more than once in the chunk."""
    def sort(frames):
        for frame in frames:
            for row in frame.itertuples():  # one chunk's rows at a time
                _, bounds, data = _opened(row)
                keys, n = np.unique(sampled(data, bounds, length, lead)[0], return_counts=True)
                at = _by_bucket(keys, buckets)
                rows = [(k, row.chunk, pack_sorted(keys[at[k]:at[k + 1]]), pack((n[at[k]:at[k + 1]] > 1).astype(np.uint8)))
                        for k in range(buckets) if at[k] < at[k + 1]]
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "keys", "more"])

    return sort


def _runs(values: np.ndarray):
    """(value, first, end) of each run of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return [(int(values[a]), a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]


def _scan(batch: pd.DataFrame, levels: pd.DataFrame) -> pd.DataFrame:
    """Merge one bucket of a batch with the levels: reported suffixes per chunk, and the batch's level."""
    rows, keys, chunk, twice = [], [], [], []
    for r in batch.itertuples():
        keys.append(unpack_sorted(r.keys))
        chunk.append(np.full(len(keys[-1]), r.chunk))
        twice.append(unpack(r.more, np.uint8).astype(bool))
    if not keys:
        return pd.DataFrame(rows, columns=["part", "bucket", "chunk", "keys", "more"])
    bucket = int(batch["bucket"].iloc[0])
    keys, chunk, twice = np.concatenate(keys), np.concatenate(chunk), np.concatenate(twice)
    order = np.argsort(keys, kind="stable")
    keys, chunk, twice = keys[order], chunk[order], twice[order]
    same = keys[1:] == keys[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    reported = []
    for r in levels.itertuples():
        old, holder = unpack_sorted(r.keys), unpack(r.more, np.int64)
        at = np.minimum(np.searchsorted(old, keys), len(old) - 1)
        met = old[at] == keys
        twice |= met
        reported.append((old[at[met]], holder[at[met]]))
    reported.append((keys[twice], chunk[twice]))
    hit, holder = (np.concatenate(x) for x in zip(*reported, strict=True))
    order = np.lexsort((hit, holder))
    hit, holder = hit[order], holder[order]
    for c, a, b in _runs(holder):
        rows.append(("report", bucket, c, pack_sorted(np.unique(hit[a:b])), None))
    first = np.concatenate([[True], ~same])
    rows.append(("level", bucket, -1, pack_sorted(keys[first]), pack(chunk[first])))
    return pd.DataFrame(rows, columns=["part", "bucket", "chunk", "keys", "more"])


def _merge(levels: pd.DataFrame) -> pd.DataFrame:
    """Two levels of a bucket as one; a suffix that both hold has been reported to both holders."""
    keys = np.concatenate([unpack_sorted(k) for k in levels["keys"]])
    holder = np.concatenate([unpack(m, np.int64) for m in levels["more"]])
    keys, first = np.unique(keys, return_index=True)
    return pd.DataFrame([(int(levels["bucket"].iloc[0]), pack_sorted(keys), pack(holder[first]))], columns=["bucket", "keys", "more"])


class IndexFamily:
    """Levels of sampled suffixes whose sizes are powers of two batches."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def scan(self, arrays: DataFrame) -> DataFrame:
        """Reports (chunk, keys) of a batch's suffix arrays; the batch then joins the index."""
        level_schema = "bucket int, keys binary, more binary"
        if self.levels:
            known = self.levels[0][1]
            for _, level in self.levels[1:]:
                known = known.unionByName(level)
        else:
            known = arrays.select("bucket", "keys", "more").limit(0)
        out = arrays.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(
            _scan, "part string, bucket int, chunk bigint, keys binary, more binary")
        out = stage(out, "suffix-scan")
        self.levels.append((1, out.where("part = 'level'").select("bucket", "keys", "more")))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, newer), (_, older) = self.levels.pop(), self.levels.pop()
            merged = older.unionByName(newer).groupBy("bucket").applyInPandas(_merge, level_schema)
            self.levels.append((2 * size, stage(merged, "suffix-level")))
        return out.where("part = 'report'").select("chunk", "keys")


_FOUND = ["part", "bucket", "chunk", "keys", "docs", "first", "sizes", "data"]
_FOUND_SCHEMA = "part string, bucket int, chunk bigint, keys binary, docs binary, first binary, sizes binary, data binary"


def _surroundings(buckets: int, length: int, lead: int):
    """Of a chunk's reported suffixes: the bytes of all windows that name them, dealt by suffix; and
    marks (window starts) of surroundings that stand earlier in the chunk already."""
    def cut(chunk: pd.DataFrame, reports: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(chunk) and len(reports):
            row = next(chunk.itertuples())
            docs, bounds, data = _opened(row)
            keys, first, last = sampled(data, bounds, length, lead)
            wanted = np.unique(np.concatenate([unpack_sorted(k) for k in reports["keys"]]))
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            chosen = wanted[at] == keys
            keys, first, last = keys[chosen], first[chosen], last[chosen]
            text = np.searchsorted(bounds, first, "right") - 1
            whole = span_hashes(data, first, last + length)
            order = np.lexsort((first, docs[text], whole, keys))
            again = np.zeros(len(keys), bool)
            again[1:] = (keys[order][1:] == keys[order][:-1]) & (whole[order][1:] == whole[order][:-1])
            later, sent = order[again], order[~again]
            if len(later):
                rows.append(("mark", -1, row.chunk, None, None, pack(first[later]), pack(last[later]), None))
            bucket = (mix(keys[sent]) % _U(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for k in range(buckets):
                mine = sent[by[cuts[k]:cuts[k + 1]]]
                if len(mine):
                    size = last[mine] + length - first[mine]
                    place = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                    rows.append(("text", k, row.chunk, pack(keys[mine]), pack(docs[text[mine]]), pack(np.stack([first[mine], first[mine] - bounds[text[mine]]])
                                .ravel()), pack(size), pack(data[place])))
        return pd.DataFrame(rows, columns=_FOUND)

    return cut


def _cells(keys: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """The cell of each suffix of a bucket; a bucket has ``CELLS`` of them."""
    return bucket * CELLS + (mix(keys) // _U(buckets) % _U(CELLS)).astype(np.int64)


def _cell_sizes(buckets: int, length: int):
    """Windows per cell of the surroundings a task reads."""
    def count(frames):
        total = np.zeros(buckets * CELLS, np.int64)
        for frame in frames:
            for r in frame.itertuples():
                np.add.at(total, _cells(unpack(r.keys, np.uint64), r.bucket, buckets), unpack(r.sizes, np.int64) - length + 1)
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells, "windows": total[cells]})

    return count


def _windows(sizes: np.ndarray, length: int):
    """(item, window in it, place of the window in the bytes of all items)."""
    windows = sizes - length + 1
    of = np.repeat(np.arange(len(sizes)), windows)
    step = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    return of, step, np.repeat(np.cumsum(sizes) - sizes, windows) + step


def _deal(hot: np.ndarray, buckets: int, groups: int, length: int):
    """Rows of surroundings without hot cells; the windows of those, dealt to groups by their content,
    and marks of windows that an equal one in the chunk precedes. ``hot`` is sorted."""
    def split(frames):
        for frame in frames:
            for r in frame.itertuples():  # one row's windows at a time
                keys, docs, sizes = unpack(r.keys, np.uint64), unpack(r.docs, np.int64), unpack(r.sizes, np.int64)
                both, data = unpack(r.first, np.int64).reshape(2, -1), unpack(r.data, np.uint8)
                is_hot = np.isin(_cells(keys, r.bucket, buckets), hot)
                of_byte = np.repeat(is_hot, sizes)
                rows = []
                cold = ~is_hot
                if cold.any():
                    rows.append(("text", r.bucket, r.chunk, pack(keys[cold]), pack(docs[cold]), pack(both[:, cold].ravel()),
                                 pack(sizes[cold]), pack(data[~of_byte])))
                if is_hot.any():
                    keys, docs, sizes, both, data = keys[is_hot], docs[is_hot], sizes[is_hot], both[:, is_hot], data[of_byte]
                    of, step, at = _windows(sizes, length)
                    content = span_hashes(data, at, at + length)
                    keys, docs, start, inside = keys[of], docs[of], both[0][of] + step, both[1][of] + step
                    order = np.lexsort((inside, docs, content, keys))
                    again = np.zeros(len(order), bool)
                    again[1:] = (content[order][1:] == content[order][:-1]) & (keys[order][1:] == keys[order][:-1])
                    later, sent = start[order[again]], order[~again]
                    if len(later):
                        rows.append(("mark", -1, r.chunk, None, None, pack(later), pack(later), None))
                    group = (mix(content[sent]) % _U(groups)).astype(np.int64)
                    sent = sent[np.argsort(group, kind="stable")]
                    for g, a, b in _runs(np.sort(group)):
                        mine = sent[a:b]
                        rows.append(("window", g, r.chunk, pack(keys[mine]), pack(docs[mine]), pack(start[mine]),
                                     pack(inside[mine]), pack(content[mine])))
                yield pd.DataFrame(rows, columns=_FOUND)

    return split


def _marks(home: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    by = np.argsort(home, kind="stable")
    home, low, high = home[by], low[by], high[by]
    rows = [(c, pack(low[a:b]), pack(high[a:b])) for c, a, b in _runs(home)]
    return pd.DataFrame(rows, columns=["chunk", "first", "sizes"])


def _compare_windows(group: pd.DataFrame) -> pd.DataFrame:
    """Marks of windows that an equal one precedes, for one group of dealt windows."""
    kinds = {"keys": np.uint64, "docs": np.int64, "first": np.int64, "sizes": np.int64, "data": np.uint64}
    keys, docs, start, inside, content = (
        np.concatenate([unpack(v, kind) for v in group[name]]) for name, kind in kinds.items())
    chunk = np.repeat(group["chunk"].to_numpy(), [len(unpack(v, np.int64)) for v in group["first"]])
    order = np.lexsort((inside, docs, content, keys))
    again = order[1:][(content[order][1:] == content[order][:-1]) & (keys[order][1:] == keys[order][:-1])]
    return _marks(chunk[again], start[again], start[again])


def _compare(length: int):
    """Marks (runs of window starts) of windows that an equal one precedes, for one bucket of suffixes."""
    def repeats(keys, docs, inside, sizes, data):
        """(item, window in it) of the windows of some items that an equal one of the same suffix precedes."""
        of, step, at = _windows(sizes, length)
        content = span_hashes(data, at, at + length)
        order = np.lexsort((inside[of] + step, docs[of], keys[of], content))
        again = np.zeros(len(of), bool)
        again[1:] = (content[order][1:] == content[order][:-1]) & (keys[of[order]][1:] == keys[of[order]][:-1])
        marked = np.sort(order[again])
        return of[marked], step[marked]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        keys, docs, chunk, first, inside, sizes, data = [], [], [], [], [], [], []
        for r in group.itertuples():
            keys.append(unpack(r.keys, np.uint64))
            docs.append(unpack(r.docs, np.int64))
            chunk.append(np.full(len(keys[-1]), r.chunk))
            both = unpack(r.first, np.int64).reshape(2, -1)
            first.append(both[0])
            inside.append(both[1])
            sizes.append(unpack(r.sizes, np.int64))
            data.append(unpack(r.data, np.uint8))
        keys, docs, chunk, first, inside, sizes, data = map(np.concatenate, (keys, docs, chunk, first, inside, sizes, data))
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(keys, kind="stable")
        fresh = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        # Blocks of whole suffixes, of about so many windows, bound the memory of the comparison.
        block = np.maximum.accumulate(np.where(fresh, (np.cumsum(sizes[order] - length + 1) - 1) // BLOCK_WINDOWS, 0))
        homes, lows, highs = [], [], []
        for _, a, b in _runs(block):
            mine = order[a:b]
            size = sizes[mine]
            place = np.repeat(begin[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            item, step = repeats(keys[mine], docs[mine], inside[mine], size, data[place])
            if not len(item):
                continue
            start = np.ones(len(item), bool)
            start[1:] = (item[1:] != item[:-1]) | (step[1:] != step[:-1] + 1)
            lo = np.flatnonzero(start)
            hi = np.append(lo[1:], len(item)) - 1
            homes.append(chunk[mine[item[lo]]])
            lows.append(first[mine[item[lo]]] + step[lo])
            highs.append(first[mine[item[hi]]] + step[hi])
        if not homes:
            return pd.DataFrame([], columns=["chunk", "first", "sizes"])
        return _marks(*map(np.concatenate, (homes, lows, highs)))

    return compare


def _removed(length: int):
    """Per document of a chunk: doc, n_bytes, n_removed, n_spans, kept_sha256."""
    def remove(chunk: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        row = next(chunk.itertuples())
        docs, bounds, data = _opened(row)
        depth = np.zeros(len(data) + 1, np.int32)
        for m in marks.itertuples():
            np.add.at(depth, unpack(m.first, np.int64), 1)
            np.add.at(depth, unpack(m.sizes, np.int64) + length, -1)
        gone = np.cumsum(depth, out=depth)[:-1] > 0
        rows = []
        for doc, a, b in zip(docs.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part = gone[a:b]
            spans = int(part[:1].sum() + (part[1:] & ~part[:-1]).sum())
            rows.append((doc, b - a, int(part.sum()), spans, hashlib.sha256(data[a:b][~part].tobytes()).hexdigest()))
        return pd.DataFrame(rows, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return remove


def _ordered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(staged doc, doc_id, digest, n_bytes of every row; rows of doc and text). ``doc`` orders the
    documents: the id itself if it is a whole number, never null and never repeated, else the rank."""
    measured = docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                           F.octet_length("text").cast("long").alias("n_bytes"))
    rows = stage(measured, "digests")
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    odd = rows.where("doc_id IS NULL").isEmpty() and rows.groupBy("doc_id").count().where("count > 1").isEmpty()
    if whole and odd:
        return rows.withColumn("doc", F.col("doc_id").cast("long")), docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    ranked = rows.select("doc_id", "digest").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "digest")
    ranked = stage(ranked.withColumn("doc", F.monotonically_increasing_id()), "ranks")
    ranked = ranked.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})

    def with_rank(df):
        return df.join(ranked, df["doc_id"].eqNullSafe(F.col("_id")) & (df["digest"] == F.col("_digest"))).drop("_id", "_digest")

    texts = with_rank(docs.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))).select("doc", "text")
    return stage(with_rank(rows), "ranked"), texts.dropDuplicates(["doc"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, lead: int = LEAD,
                   batches: int = BATCHES, chunk_bytes: int | None = None, bucket_items: int = BUCKET_ITEMS,
                   hot_windows: int = HOT_WINDOWS, dealt_windows: int = DEALT_WINDOWS) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, texts = _ordered(narrow(docs, id_col, text_col))
    if chunk_bytes is None:
        chunk_bytes = min(CHUNK_BYTES, max(LEAST_CHUNK, (rows.agg(F.sum("n_bytes")).first()[0] or 0) // CHUNKS))
    firsts = rows.where(F.col("n_bytes") >= length).groupBy("digest").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("digest", "first")
    copies = rows.join(firsts, "digest").where("doc > first")
    copies = stage(copies.select("doc", "doc_id", "n_bytes"), "copies")
    gone = copies.select("doc").distinct()
    gone = F.broadcast(gone) if copies.count() <= _BROADCAST_ROWS else gone
    with small_batches(docs.sparkSession, rows=READ_ROWS):  # of every job here, as chunks are long rows
        chunked = stage(chunks(texts.join(gone, "doc", "left_anti"), chunk_bytes), "suffix-chunks", **_GROUPS)
        total = int(chunked.agg(F.sum("n_bytes")).first()[0] or 0)
        buckets = max(1, -(-total // (30 * bucket_items)))
        family, reports = IndexFamily(), None
        for k in range(batches):
            batch = chunked.where(F.pmod(F.xxhash64("chunk"), F.lit(batches)) == k)
            arrays = batch.mapInPandas(_suffix_arrays(buckets, length, lead), "bucket int, chunk bigint, keys binary, more binary")
            found = family.scan(arrays)
            reports = found if reports is None else reports.unionByName(found)
        reported = chunked.groupBy("chunk").cogroup(reports.groupBy("chunk"))
        spread = max(1, -(-total // BUCKET_WINDOWS))
        found = stage(reported.applyInPandas(_surroundings(spread, length, lead), _FOUND_SCHEMA), "surroundings")
        texts = found.where("part = 'text'")
        mark_schema = "chunk bigint, first binary, sizes binary"
        few = 4 * docs.sparkSession.sparkContext.defaultParallelism
        cells = texts.select("bucket", "keys", "sizes").coalesce(few).mapInPandas(_cell_sizes(spread, length), "cell bigint, windows bigint")
        cells = cells.groupBy("cell").agg(F.sum("windows").alias("windows")).where(F.col("windows") > hot_windows).collect()
        marks = found.where("part = 'mark'").select("chunk", "first", "sizes")
        if cells:
            groups = -(-sum(r["windows"] for r in cells) // dealt_windows)
            hot = np.sort(np.array([r["cell"] for r in cells], np.int64))
            held = F.broadcast(docs.sparkSession.createDataFrame([(int(b),) for b in np.unique(hot // CELLS)], "bucket int"))
            dealt = stage(texts.join(held, "bucket", "left_semi").select(*_FOUND).mapInPandas(
                _deal(hot, spread, groups, length), _FOUND_SCHEMA), "dealt-windows")
            texts = texts.join(held, "bucket", "left_anti").select(*_FOUND).unionByName(dealt.where("part = 'text'"))
            marks = marks.unionByName(dealt.where("part = 'mark'").select("chunk", "first", "sizes"))
            marks = marks.unionByName(dealt.where("part = 'window'").groupBy("bucket").applyInPandas(_compare_windows, mark_schema))
        marks = marks.unionByName(texts.groupBy("bucket").applyInPandas(_compare(length), mark_schema))
        told = stage(chunked.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInPandas(
            _removed(length), "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"), "told")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = copies.select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"),
                          F.lit(1).cast("long").alias("n_spans"), F.lit(nothing).alias("kept_sha256"))
    names = rows.select(F.col("doc").alias("_doc"), "doc_id")
    told = told.join(names, told["doc"] == F.col("_doc")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return told.unionByName(whole)


def op10(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
