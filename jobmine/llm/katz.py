"""Katz backoff language model: Good-Turing discounted bigrams over discounted unigrams.

Tokens are words and one end per text. Texts are read once and kept as chunks of about eight
megabytes: the chunk's vocabulary and a code per token. What is looked up or added up over the
corpus travels as compressed, sorted number blocks per (chunk, bucket), never more rows than distinct
n-grams, and the answers come back in the same order without the keys:

1. words: counts of every word over all training texts, and a number for every word;
2. pairs: counts of every pair over all training texts, dealt by the first word; first words with
   more than a bucket's share of all tokens are dealt by the pair, so no bucket grows with one key;
3. backoff weights of every first word, from sums over the pairs seen after it;
4. the score of each token: discounted relative frequency if its pair was seen, else the backoff
   weight of its history times the score of the token one order below, recursively.

The tables of words and pairs with their counts are partitioned by order and bucket. Counts up to
``CUT`` are discounted by Good-Turing's estimate. A history whose pairs leave no mass (all counts
above the cut) has one count added to its total. Unseen words share what the unigram discounts leave, so
the probabilities after any history, with one unknown word, add up to one.

Defined cases: a null text is empty (one end); a null id is never held out; repeated rows count and
are scored each; without training texts every word is unknown and has the uniform probability one.
Other columns may have any names. Word numbers must stay below 2**32 (checked).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import mix, slices, words
from jobmine.llm.common import fold, narrow
from jobmine.session import stage, staging_dir

CHUNK_BYTES = 8 << 20
BUCKET_ITEMS = 1 << 20
CUT = 5
_U = np.uint64
_END = int(mix(np.full(1, 0x51ED270B, np.uint64))[0])
_START = int(mix(np.full(1, 0x6A09E667, np.uint64))[0])


def pack(values: np.ndarray) -> bytes:
    """Numbers as one compressed block, first bytes first, so that the empty high bytes shrink."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), -1).T if len(raw) else raw
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(planes.tobytes(), asbytes=True)


def unpack(block: bytes, kind) -> np.ndarray:
    size, kind = int.from_bytes(block[:8], "little"), np.dtype(kind)
    raw = pa.Codec("zstd").decompress(block[8:], size * kind.itemsize, asbytes=True)
    if not size:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, size).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def unpack_sorted(block: bytes) -> np.ndarray:
    return np.cumsum(unpack(block, np.uint64), dtype=np.uint64)


def chunks(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of texts; ``docs`` has doc_id, text and held_out."""
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("held", T.BinaryType()), T.StructField("ends", T.BinaryType()),
        T.StructField("vocab", T.BinaryType()), T.StructField("codes", T.BinaryType()),
        T.StructField("n_vocab", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def gather(batches):
        number = TaskContext.get().partitionId() << 32
        ids, held, counts, tokens, bytes_in = [], [], [], [], 0

        def close():
            flat = np.concatenate(tokens)
            vocab, codes = np.unique(np.concatenate([flat, np.array([_START, _END], np.uint64)]), return_inverse=True)
            ends = np.cumsum(np.concatenate(counts))
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
                pa.array([pack(np.concatenate(held))]), pa.array([pack(ends)]), pa.array([pack(vocab)]),
                pa.array([pack(codes[:-2].astype(np.int32))]), pa.array([len(vocab)]), pa.array([len(flat)])],
                schema.names)

        for batch in batches:
            for a, b, data, bounds in slices(batch.column(1)):
                hashes, at = words(data, bounds)
                ends = np.arange(1, b - a + 1) + at[1:]  # after its end token
                stream = np.full(len(hashes) + b - a, _END, np.uint64)
                inside = np.ones(len(stream), bool)
                inside[ends - 1] = False
                stream[inside] = hashes
                ids.append(batch.column(0).slice(a, b - a))
                held.append(np.asarray(batch.column(2).slice(a, b - a)).astype(np.uint8))
                counts.append(np.diff(ends, prepend=0))
                tokens.append(stream)
                bytes_in += len(data)
                if bytes_in >= size:
                    yield close()
                    number += 1
                    ids, held, counts, tokens, bytes_in = [], [], [], [], 0
        if ids:
            yield close()

    return docs.select("doc_id", "text", "held_out").mapInArrow(gather, schema)


@dataclass
class Chunk:
    vocab: np.ndarray
    codes: np.ndarray
    held: np.ndarray  # per text
    ends: np.ndarray
    text: np.ndarray  # of each token
    trained: np.ndarray  # whether a token is in a training text


def _opened(row) -> Chunk:
    ends, held = unpack(row.ends, np.int64), unpack(row.held, np.uint8).astype(bool)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return Chunk(unpack(row.vocab, np.uint64), unpack(row.codes, np.int32), held, ends, text, ~held[text])


def _bucket_bounds(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names)


_ASK = "bucket int, chunk long, keys binary, counts binary, more binary, other binary"
_ASK_NAMES = ["bucket", "chunk", "keys", "counts", "more", "other"]


def _ask_words(chunked: DataFrame, buckets: int) -> DataFrame:
    def ask(frames):
        for frame in frames:
            rows = []
            for row in frame.itertuples():
                c = _opened(row)
                n = np.bincount(c.codes[c.trained], minlength=len(c.vocab))
                n[np.searchsorted(c.vocab, _U(_START))] = int((~c.held).sum())
                at = _bucket_bounds(c.vocab, buckets)
                rows += [(k, row.chunk, pack_sorted(c.vocab[at[k]:at[k + 1]]), pack(n[at[k]:at[k + 1]]), None, None)
                         for k in range(buckets) if at[k] < at[k + 1]]
            yield _frame(rows, _ASK_NAMES)

    return chunked.select("chunk", "held", "ends", "vocab", "codes").mapInPandas(ask, _ASK)


_ANSWER = "part string, chunk long, bucket int, a binary, b binary, c binary, d binary, spectrum array<long>"
_ANSWER_NAMES = ["part", "chunk", "bucket", "a", "b", "c", "d", "spectrum"]


def _spectrum(counts: np.ndarray) -> list[int]:
    """Numbers of items with count 1 .. CUT + 1, of items seen, and the sum of the counts."""
    low = np.bincount(counts[(counts > 0) & (counts <= CUT + 1)], minlength=CUT + 2)[1:CUT + 2]
    return [*map(int, low), int((counts > 0).sum()), int(counts.sum())]


def _count_words(group: pd.DataFrame) -> pd.DataFrame:
    """The bucket's table (hashes, counts), and each chunk's words as places in it with their counts."""
    bucket = int(group["bucket"].iloc[0])
    asked = [unpack_sorted(k) for k in group["keys"]]
    known, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpack(n, np.int64) for n in group["counts"]])).astype(np.int64)
    tokens = total[known != _U(_START)]
    rows = [("table", -1, bucket, pack_sorted(known), pack(total), None, None, _spectrum(tokens))]
    at = 0
    for chunk, keys in zip(group["chunk"], asked, strict=True):
        mine = place[at:at + len(keys)]
        rows.append(("answer", chunk, bucket, pack_sorted(mine.astype(np.uint64)), pack(total[mine]), None, None, [len(known)]))
        at += len(keys)
    return _frame(rows, _ANSWER_NAMES)


def _numbered(c: Chunk, answers: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and training counts of a chunk's vocabulary."""
    number, count = np.zeros(len(c.vocab), np.uint64), np.zeros(len(c.vocab), np.int64)
    at = _bucket_bounds(c.vocab, buckets)
    for r in answers.itertuples():
        here = slice(at[r.bucket], at[r.bucket + 1])
        number[here] = unpack_sorted(r.a) * _U(buckets) + _U(r.bucket)
        count[here] = unpack(r.b, np.int64)
    return number, count


@dataclass
class Shape:
    word_buckets: int
    pair_buckets: int
    hot: int  # histories with more tokens are dealt by the pair


def _pairs(c: Chunk, number: np.ndarray, count: np.ndarray, shape: Shape):
    """(sorted distinct pairs, pair of each token, history and word codes, bucket of each pair)."""
    before = np.empty_like(c.codes)
    before[1:] = c.codes[:-1]
    before[np.concatenate([[0], c.ends[:-1]])] = np.searchsorted(c.vocab, _U(_START))
    joined = (number[before] << _U(32)) | number[c.codes]
    pairs, first, of = np.unique(joined, return_index=True, return_inverse=True)
    history, word = before[first], c.codes[first]
    spread = np.where(count[history] > shape.hot, mix(pairs), mix(number[history]))
    return pairs, of, history, word, (spread % _U(shape.pair_buckets)).astype(np.int64)


def _ask_pairs(shape: Shape):
    def ask(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(chunk.itertuples())
        c = _opened(row)
        number, count = _numbered(c, answers, shape.word_buckets)
        pairs, of, history, word, bucket = _pairs(c, number, count, shape)
        n = np.bincount(of[c.trained], minlength=len(pairs)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(shape.pair_buckets + 1))
        rows = []
        for k in range(shape.pair_buckets):
            mine = order[at[k]:at[k + 1]]
            if len(mine):
                rows.append((k, row.chunk, pack_sorted(pairs[mine]), pack(n[mine]),
                             pack(count[history[mine]]), pack(count[word[mine]])))
        return _frame(rows, _ASK_NAMES)

    return ask


def _count_pairs(group: pd.DataFrame) -> pd.DataFrame:
    """The bucket's table (pairs, counts, counts of history and word), and each chunk's counts."""
    bucket = int(group["bucket"].iloc[0])
    asked = [unpack_sorted(k) for k in group["keys"]]
    known, first, place = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    total = np.bincount(place, np.concatenate([unpack(n, np.int32) for n in group["counts"]])).astype(np.int64)
    history = np.concatenate([unpack(n, np.int64) for n in group["more"]])[first]
    word = np.concatenate([unpack(n, np.int64) for n in group["other"]])[first]
    seen = total > 0
    rows = [("table", -1, bucket, pack_sorted(known[seen]), pack(total[seen]), pack(history[seen]), pack(word[seen]), _spectrum(total))]
    at = 0
    for chunk, keys in zip(group["chunk"], asked, strict=True):
        rows.append(("answer", chunk, bucket, pack(total[place[at:at + len(keys)]].astype(np.int32)), None, None, None, None))
        at += len(keys)
    return _frame(rows, _ANSWER_NAMES)


@dataclass
class Levels:
    """Discounts by count for both orders, and the corpus totals."""

    tokens: int
    words: int
    word_discounts: np.ndarray
    pair_discounts: np.ndarray
    word_scale: float
    unknown: float

    def word_scores(self, count: np.ndarray) -> np.ndarray:
        """Probability of words by their training counts; all unseen words are one unknown word."""
        if not self.tokens:
            return np.ones(len(count))
        kept = count * _discounted(count, self.word_discounts) * self.word_scale / self.tokens
        return np.where(count > 0, kept, self.unknown)


def _discounted(count: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    return discounts[np.minimum(count, CUT + 1)]


def good_turing(spectrum: list[int]) -> np.ndarray:
    """Discount factors of counts 0 .. CUT + 1 (the last for all above); 1 where no estimate is in (0, 1]."""
    n = np.array([0, *spectrum[:CUT + 1]], float)
    out = np.ones(CUT + 2)
    if n[1] <= 0:
        return out
    rest = (CUT + 1) * n[CUT + 1] / n[1]
    for r in range(1, CUT + 1):
        if n[r] > 0 and rest < 1:
            d = ((r + 1) * n[r + 1] / (n[r] * r) - rest) / (1 - rest)
            out[r] = d if 0 < d <= 1 else 1.0
    return out


def _levels(word_spectrum: list[int], pair_spectrum: list[int], kept: float) -> Levels:
    tokens, distinct = word_spectrum[-1], word_spectrum[-2]
    scale = 1.0 if kept < 1 - 1e-9 else tokens / (tokens + 1)
    return Levels(tokens, distinct, good_turing(word_spectrum), good_turing(pair_spectrum), scale, 1 - kept * scale)


def _kept_mass(spectrum: list[int]) -> float:
    """Share of the tokens that stays with seen words after discounting."""
    tokens = spectrum[-1]
    if not tokens:
        return 0.0
    r = np.arange(1, CUT + 1)
    low = np.array(spectrum[:CUT], float)
    discounts = good_turing(spectrum)[1:CUT + 1]
    return float((tokens - (r * low).sum() + (discounts * r * low).sum()) / tokens)


def _history_sums(levels: Levels, word_buckets: int):
    """Per table of pairs: first words (by their bucket), discounted mass and lower-order mass of what was seen after them."""
    def add(frames):
        for frame in frames:
            rows = []
            for t in frame.itertuples():
                pairs = unpack_sorted(t.a)
                if not len(pairs):
                    continue
                count, total, word = unpack(t.b, np.int64), unpack(t.c, np.int64), unpack(t.d, np.int64)
                first, of = np.unique(pairs >> _U(32), return_inverse=True)
                high = np.bincount(of, count * _discounted(count, levels.pair_discounts) / total)
                low = np.bincount(of, levels.word_scores(word))
                bucket = (first % _U(word_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                at = np.searchsorted(bucket[order], np.arange(word_buckets + 1))
                for k in range(word_buckets):
                    mine = order[at[k]:at[k + 1]]
                    if len(mine):
                        rows.append((k, pack(first[mine] // _U(word_buckets)), pack(high[mine]), pack(low[mine])))
            yield _frame(rows, ["bucket", "places", "high", "low"])

    return add


def _places(answer) -> np.ndarray:
    return unpack_sorted(answer.a).astype(np.int64)


def _backoff(sums: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's words in this bucket: the backoff weight and the scale of its seen pairs."""
    if not len(asked):
        return _frame([], ["chunk", "bucket", "a", "b"])
    size = int(asked["spectrum"].iloc[0][0])
    high, low, total = np.zeros(size), np.zeros(size), np.zeros(size)
    for s in sums.itertuples():
        place = unpack(s.places, np.uint64).astype(np.int64)
        high[place] += unpack(s.high, np.float64)
        low[place] += unpack(s.low, np.float64)
    for r in asked.itertuples():
        total[_places(r)] = unpack(r.b, np.int64)
    scale = np.where((high > 1 - 1e-9) & (total > 0), total / (total + 1), 1.0)
    weight = np.where(total > 0, (1 - high * scale) / np.maximum(1 - low, 1e-300), 1.0)
    rows = [(r.chunk, r.bucket, pack(weight[_places(r)]), pack(scale[_places(r)])) for r in asked.itertuples()]
    return _frame(rows, ["chunk", "bucket", "a", "b"])


_SCORE_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _score(levels: Levels, shape: Shape):
    def judge(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(chunk.itertuples())
        c = _opened(row)
        number, count = _numbered(c, answers[answers["kind"] == "word"], shape.word_buckets)
        weight, scale = np.ones(len(c.vocab)), np.ones(len(c.vocab))
        at = _bucket_bounds(c.vocab, shape.word_buckets)
        for r in answers[answers["kind"] == "backoff"].itertuples():
            here = slice(at[r.bucket], at[r.bucket + 1])
            weight[here], scale[here] = unpack(r.a, np.float64), unpack(r.b, np.float64)
        pairs, of, history, word, bucket = _pairs(c, number, count, shape)
        seen = np.zeros(len(pairs), np.int64)
        order = np.argsort(bucket, kind="stable")
        spans = np.searchsorted(bucket[order], np.arange(shape.pair_buckets + 1))
        for r in answers[answers["kind"] == "pair"].itertuples():
            seen[order[spans[r.bucket]:spans[r.bucket + 1]]] = unpack(r.a, np.int32)

        def probability(orders: int) -> np.ndarray:  # of each distinct pair's word, after up to one word
            if orders == 1:
                return levels.word_scores(count[word])
            lower = weight[history] * probability(orders - 1)
            total = np.maximum(count[history], 1)
            return np.where(seen > 0, seen * _discounted(seen, levels.pair_discounts) * scale[history] / total, lower)

        logs = np.log10(probability(2))[of]
        n = count[c.codes]
        base = np.log10((n + 1) / (levels.tokens + levels.words + 1))
        texts = len(c.ends)
        return pd.DataFrame({
            "doc_id": list(row.ids), "held_out": c.held, "n_tokens": np.diff(c.ends, prepend=0),
            "n_known": np.bincount(c.text, n > 0, minlength=texts).astype(np.int64), "train_tokens": levels.tokens,
            "base_score": np.bincount(c.text, base, minlength=texts), "score": np.bincount(c.text, logs, minlength=texts),
        }, columns=_SCORE_NAMES)

    return judge


def _sum_spectra(tables: DataFrame) -> list[int]:
    sums = tables.select([F.coalesce(F.sum(F.get("spectrum", F.lit(i))), F.lit(0)).alias(f"s{i}") for i in range(CUT + 3)])
    return [int(v) for v in sums.first()]


def _kept(df: DataFrame, path: str, order: int) -> DataFrame:
    """Written under the model's folder, by order and part."""
    path = f"{path}/order={order}"
    df.write.partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score_texts(docs: DataFrame, bucket_items: int = BUCKET_ITEMS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of all texts by the model of those that are not held out; ``docs`` has doc_id, text and held_out."""
    spark = docs.sparkSession
    folder = f"{staging_dir(spark)}/katz-{uuid.uuid4().hex}"
    chunked = stage(chunks(docs, chunk_bytes), "katz-chunks")
    sizes = chunked.agg(F.sum("n_vocab"), F.sum("n_tokens")).first()
    asked, tokens = int(sizes[0] or 0), int(sizes[1] or 0)
    shape = Shape(max(1, -(-asked // bucket_items)), max(1, -(-tokens // bucket_items)), 0)
    counted = _ask_words(chunked, shape.word_buckets).groupBy("bucket").applyInPandas(_count_words, _ANSWER)
    word_rows = _kept(counted, folder, 1)
    word_spectrum = _sum_spectra(word_rows.where("part = 'table'"))
    largest = word_rows.where("part = 'answer'").agg(F.max(F.get("spectrum", F.lit(0)))).first()[0] or 0
    if largest * shape.word_buckets >= 1 << 32:
        raise ValueError("more than 2**32 word numbers")
    shape.hot = word_spectrum[-1] // shape.pair_buckets
    word_answers = word_rows.where("part = 'answer'").drop("part", "d")
    asked_pairs = chunked.groupBy("chunk").cogroup(word_answers.groupBy("chunk")).applyInPandas(_ask_pairs(shape), _ASK)
    pair_rows = _kept(asked_pairs.groupBy("bucket").applyInPandas(_count_pairs, _ANSWER), folder, 2)
    tables = pair_rows.where("part = 'table'")
    levels = _levels(word_spectrum, _sum_spectra(tables), _kept_mass(word_spectrum))
    sums = tables.select("a", "b", "c", "d").mapInPandas(
        _history_sums(levels, shape.word_buckets), "bucket int, places binary, high binary, low binary")
    weights = sums.groupBy("bucket").cogroup(word_answers.groupBy("bucket")).applyInPandas(
        _backoff, "chunk long, bucket int, a binary, b binary")
    weights = stage(weights, "katz-backoff")
    none = F.lit(None).cast("binary")
    answers = (
        word_answers.select(F.lit("word").alias("kind"), "chunk", "bucket", "a", "b")
        .unionByName(weights.select(F.lit("backoff").alias("kind"), "chunk", "bucket", "a", "b"))
        .unionByName(pair_rows.where("part = 'answer'").select(F.lit("pair").alias("kind"), "chunk", "bucket", "a", none.alias("b"))))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_score(levels, shape), schema)


def op1(docs: DataFrame) -> DataFrame:
    return score_texts(narrow(docs).withColumn("held_out", fold(F.col("doc_id"), 7, 2)))
