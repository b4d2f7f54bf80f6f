"""Helpers shared by the operators: input shape, row keys, folds, joins back to the documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmine.session import small_batches  # noqa: F401  for the operators here

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that other columns cannot clash with ours."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def fold(id_col: Column, parts: int, held: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out remainder; a null id never does."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == held, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def text_key(text: Column) -> Column:
    """A 128-bit key of the whole text; with the id it names a document even if ids repeat."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def matching(docs: DataFrame, decided: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) a row of ``decided``, which
    has the columns ``doc_id`` and ``text_key``. Columns of ``docs`` may have any names."""
    marked = decided.select(F.col("doc_id").alias("_decided_id"), F.col("text_key").alias("_decided_key")).distinct()
    same = docs[id_col].eqNullSafe(marked["_decided_id"]) & (text_key(docs[text_col]) == marked["_decided_key"])
    return docs.join(marked, same, how)


def only_row(df: DataFrame) -> dict:
    """The single row of an aggregate without groups."""
    return df.first().asDict()


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
