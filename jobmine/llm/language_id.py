"""Language identification by rank-order profiles.

A profile holds the most frequent character n-grams (one to three letters, words padded by a
separator) of all training texts of a language. A text's own most frequent n-grams are compared with
each profile: the distance is the sum of the differences in rank, and the profile's size for an
n-gram that it lacks. The nearest profile wins; the score is one minus the distance's share of the
largest possible one.

Defined cases: texts that are null or without a letter get ``und`` and 0, as do all texts if nothing
could be learned; ties go to the language that comes first by name; rows without a language teach
nothing; repeated rows count as often as they occur. Whole texts are read, a quarter megabyte at a time
(a longer text alone). The table of profiles has a fixed number of rows per language and is checked.

``keep_known`` drops a row if its text has no letter, if it shares no n-gram with any profile, or if it
scores far below what labelled texts of the predicted language score at its length. That bound is learned from every labelled row: a share of
a low quantile of the scores per language and length class. Where fewer than a hundred rows teach a
class the nearest taught ones give the bound, and a text shorter than all taught classes is kept, as
is every text with a letter when no language was learned. Empty tables give empty results, very long
texts belong to the longest class, and other columns may have any names.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import slices
from jobmine.llm.common import fold, narrow, small_batches
from jobmine.session import stage

UNKNOWN = "und"
PROFILE_SIZE = 400
LOW_SHARE = 0.01  # of a class's labelled texts
BOUND_SHARE = 0.5  # of the score that share stays under
CLASS_ROWS = 100
SCORE_STEPS = 1_000
MAX_LANGUAGES = 2_000
MERGE_AT = 1 << 19  # n-grams that a task holds, of all languages
SLICE_BYTES = 1 << 18
_SEP = 1  # stands for any run of other characters


@dataclass
class Profiles:
    """Languages in order of name, and per language its n-grams in order and their ranks."""

    languages: list[str]
    grams: list[np.ndarray]
    ranks: list[np.ndarray]
    size: int


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _marked(column: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and separators of all texts in a row, and the text of each letter."""
    low = pc.utf8_lower(column)
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(low.to_pylist()).encode("utf-32-le"), np.uint32)
    text = np.repeat(np.arange(len(sizes)), sizes)
    marked = np.full(len(points) + len(sizes) + 1, _SEP, np.int64)
    owner = np.zeros(len(marked), np.int64)
    place = np.arange(len(points)) + text + 1
    marked[place] = np.where(letters[points], points, _SEP)
    owner[place] = text
    keep = np.ones(len(marked), bool)
    keep[1:] = (marked[1:] != _SEP) | (marked[:-1] != _SEP)
    return marked[keep], owner[keep]


def _grams(marked: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted keys (text, then n-gram) of every n-gram; the alphabet, which places are letters, and
    the bits that a letter takes in a key."""
    alphabet, code = np.unique(marked, return_inverse=True)
    code = code.astype(np.uint64) + np.uint64(1)
    bits = int(len(alphabet)).bit_length()
    b, o = np.uint64(bits), owner.astype(np.uint64) << np.uint64(3 * bits)
    letter = marked != _SEP
    one = (o | code)[letter]
    pair = np.where(letter[:-1], o[:-1], o[1:]) | (code[:-1] << b) | code[1:]
    three = (o[1:-1] | (code[:-2] << (b + b)) | (code[1:-1] << b) | code[2:])[letter[1:-1]]
    return np.sort(np.concatenate([one, pair if letter.any() else pair[:0], three])), alphabet, letter, bits


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _spelled(keys: np.ndarray, alphabet: np.ndarray, bits: int) -> np.ndarray:
    """N-grams as code points, 21 bits each; they order as the keys do."""
    known = np.concatenate([[0], alphabet]).astype(np.int64)
    low = np.uint64((1 << bits) - 1)
    part = [known[((keys >> np.uint64(k * bits)) & low).astype(np.int64)] for k in (2, 1, 0)]
    return (part[0] << 42) | (part[1] << 21) | part[2]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([p[0] for p in parts])
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], np.concatenate([p[1] for p in parts])[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(counts, first)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) partial counts of all n-grams of all texts; ``docs`` has text and lang."""

    def count(batches):
        letters, held, size = _letters(), {}, 0

        def flush(lang):
            grams, counts = _merged(held.pop(lang))
            for at in range(0, len(grams), 100_000):
                part = grams[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(counts[at:at + 100_000])],
                    ["lang", "gram", "n"])

        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            for a, b, _, _ in slices(texts, SLICE_BYTES):
                own = langs.slice(a, b - a)
                for lang in own.unique().to_pylist():
                    part = texts.slice(a, b - a).filter(pc.equal(own, lang))
                    marked, owner = _marked(part, letters)
                    keys, alphabet, letter, bits = _grams(marked, np.zeros_like(owner))
                    if not letter.any():
                        continue
                    grams, counts = _runs(keys)
                    held.setdefault(lang, []).append((_spelled(grams, alphabet, bits), counts.astype(np.int64)))
                    size += len(grams)
                    if size > MERGE_AT:
                        for name in held:
                            held[name] = [_merged(held[name])]
                        sizes = sorted((len(parts[0][0]), name) for name, parts in held.items())
                        size = sum(n for n, _ in sizes)
                        while size > MERGE_AT // 2:
                            n, name = sizes.pop()
                            size -= n
                            yield from flush(name)
        for lang in list(held):
            yield from flush(lang)

    return docs.select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint")


def learn(docs: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of every non-null ``lang``; ``docs`` has text and lang."""
    counted = gram_counts(docs.where("lang IS NOT NULL")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), "gram"]
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(64)))
    first = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = first.where(F.col("r") <= size).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1)
    with small_batches(docs.sparkSession):
        table = stage(ranked.where(F.col("rank") < size).select("lang", "gram", "rank"), "language-profiles")
    if table.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their profiles are too many to send to every task")
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for row in table.collect():
        by_lang.setdefault(row["lang"], []).append((row["gram"], row["rank"]))
    names = sorted(by_lang)
    pairs = [np.array(sorted(by_lang[name]), np.int64) for name in names]
    return Profiles(names, [p[:, 0].copy() for p in pairs], [p[:, 1].copy() for p in pairs], size)


def _judge(texts: pa.Array, letters: np.ndarray, profiles: Profiles) -> tuple[list[str], np.ndarray]:
    marked, owner = _marked(texts, letters)
    keys, alphabet, _, bits = _grams(marked, owner)
    keys, counts = _runs(keys)
    rows, shift = len(texts), np.uint64(3 * bits)
    text = (keys >> shift).astype(np.int64)
    top = int(counts.max()) if len(counts) else 0
    order = np.argsort(text * (top + 1) + (top - counts), kind="stable")
    bounds = np.searchsorted(text, np.arange(rows + 1))
    text = text[order]
    rank = np.arange(len(text)) - bounds[text]
    chosen = rank < profiles.size
    text, rank = text[chosen], rank[chosen]
    grams = _spelled(keys[order][chosen] & np.uint64((1 << (3 * bits)) - 1), alphabet, bits)
    used = np.bincount(text, minlength=rows)
    apart = np.empty((len(profiles.languages), rows))
    for k, (known, ranks) in enumerate(zip(profiles.grams, profiles.ranks, strict=True)):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        off = np.where(known[at] == grams, np.abs(ranks[at] - rank), profiles.size)
        apart[k] = np.bincount(text, off, minlength=rows)
    if not profiles.languages:
        return [UNKNOWN] * rows, np.zeros(rows)
    best = apart.argmin(0)
    share = apart[best, np.arange(rows)] / np.maximum(used * profiles.size, 1)
    found = [profiles.languages[b] if u else UNKNOWN for b, u in zip(best, used, strict=True)]
    return found, np.where(used > 0, np.clip(1 - share, 0, 1), 0.0)


def _judged(batches, profiles: Profiles, text_at: int):
    """(batch, predictions, scores) for Arrow batches whose column ``text_at`` is the text."""
    letters = _letters()
    for batch in batches:
        texts = pc.fill_null(batch.column(text_at), "")
        found, scores = [], [np.zeros(0)]
        for a, b, _, _ in slices(texts, SLICE_BYTES, 512):
            part, score = _judge(texts.slice(a, b - a), letters, profiles)
            found += part
            scores.append(score)
        yield batch, found, np.concatenate(scores)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred and score for every row; ``docs`` has doc_id and text."""

    def predict(batches):
        for batch, found, scores in _judged(batches, profiles, 1):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    source = docs.select("doc_id", "text")
    out = T.StructType([source.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType())])
    return source.mapInArrow(predict, out)


def _length_class(text: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def score_bounds(judged: DataFrame) -> dict[str, dict[int, float]]:
    """Per language the bound of each taught length class. ``judged`` has lang, lang_pred, score and
    class of labelled rows; scores are counted in a fixed number of steps, so few numbers per class
    reach the driver."""
    steps = F.floor(F.col("score") * SCORE_STEPS).cast("int")
    counted = judged.where("lang = lang_pred").groupBy("lang", "class", steps.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang", "class").orderBy("step")
    all_rows = F.sum("n").over(Window.partitionBy("lang", "class"))
    ranked = counted.withColumns({"upto": F.sum("n").over(upto), "rows": all_rows})
    low = ranked.where((F.col("rows") >= CLASS_ROWS) & (F.col("upto") >= F.col("rows") * LOW_SHARE))
    bounds: dict[str, dict[int, float]] = {}
    for row in low.groupBy("lang", "class").agg(F.min("step").alias("step")).collect():
        bounds.setdefault(row["lang"], {})[row["class"]] = BOUND_SHARE * row["step"] / SCORE_STEPS
    return bounds


def _bound(bounds: dict[int, float], at: int) -> float:
    """The bound of a class, or the lower one of its nearest taught neighbours."""
    below, above = [c for c in bounds if c <= at], [c for c in bounds if c >= at]
    if not below:
        return 0.0
    return min(bounds[max(below)], bounds[min(above)] if above else 1.0)


def keep_known(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The whole rows whose text has a letter and scores as texts of its language do. Each text is
    judged once; the rows are written with their scores, from which the bounds are learned."""
    if not profiles.languages:
        text = F.coalesce(docs[text_col], F.lit(""))
        return docs.where(F.regexp_like(text, F.lit(r"\p{L}")))
    row = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])
    found = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    given = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def judge(batches):
        for batch, langs, scores in _judged(batches, profiles, text_at):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                             [*batch.schema.names, "lang_pred", "score"])

    length = _length_class(F.coalesce(F.col(f"c{text_at}"), F.lit("")))
    with small_batches(docs.sparkSession):
        judged = stage(given.mapInArrow(judge, T.StructType([*row.fields, *found])).withColumn("class", length), "judged")
    bounds = score_bounds(judged.select(F.col(f"c{lang_at}").alias("lang"), "lang_pred", "score", "class"))
    cells = [(lang, at, _bound(taught, at)) for lang, taught in bounds.items() for at in range(32)]
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0))
    if cells:  # a number per language and power of two
        table = docs.sparkSession.createDataFrame(cells, "lang_pred string, class int, bound double")
        kept = kept.join(F.broadcast(table), ["lang_pred", "class"], "left").where("score >= coalesce(bound, 0)")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def labelled(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Text and language of all rows, for a pipeline, which holds nothing out."""
    return docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"), docs[lang_col].alias("lang"))


def training(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             parts: int = 3, held: int = 1) -> DataFrame:
    """Text and language of the rows outside the held-out fold."""
    return labelled(docs.where(~fold(docs[id_col], parts, held)), text_col, lang_col)


def op2(docs: DataFrame) -> DataFrame:
    profiles = learn(training(docs))
    found = identify(narrow(docs), profiles)
    return found.select("doc_id", fold(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")
