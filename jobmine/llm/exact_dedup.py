"""Exact deduplication against a persistent digest index (native).

The index is a table of (digest, id of the row that stays), bucketed and sorted by digest, at a path
that outlives the session. A batch is reduced to one row per digest, anti-joined with the index by
sort-merge (the index is not shuffled) and what is new is appended. Digests are SHA-256 of the text
as it is.

Defined cases: a null text equals an empty one. Of equal texts the largest id stays, a null id is
the smallest; rows that repeat an id with an equal text count as copies in ``group_size``, all of
them are marked kept in the report, and one of them (the largest by its other columns) survives in
``survivors``. Empty tables give empty results. Other columns may have any names.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.common import narrow, only_row
from jobmine.operators.rows import compute_once
from jobmine.operators.suspects import bloom_filter, may_hold
from jobmine.session import stage, staging_dir

BUCKETS = 32


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """A bucketed table at ``path``; opened again by a later session under the same path."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {id_type}) USING PARQUET"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, digests: DataFrame) -> None:
        """Add what the index does not hold yet: the largest id of each new digest."""
        groups = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        dealt = groups.repartition(self.buckets, "digest")
        new = dealt.hint("merge").join(self.rows(), "digest", "left_anti")
        new.select("digest", "keep_id").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def _batches(digests: DataFrame, batches: int) -> list[DataFrame]:
    """Batches by falling id, so that the row that comes first is the one that stays."""
    if batches < 2 or not isinstance(digests.schema["doc_id"].dataType, T.NumericType):
        return [digests]
    shares = [i / batches for i in range(1, batches)]
    cuts = only_row(digests.agg(F.percentile_approx("doc_id", shares, 10_000).alias("cuts")))["cuts"]
    if not cuts:
        return [digests]
    cuts, out, rest = sorted(set(cuts), reverse=True), [], F.lit(True)
    for cut in cuts:
        above = F.coalesce(F.col("doc_id") >= cut, F.lit(False))
        out.append(digests.where(rest & above))
        rest = rest & ~above
    return [*out, digests.where(rest)]


def _grouped(docs: DataFrame, id_col: str, text_col: str, batches: int, index: DigestIndex | None) -> tuple[DataFrame, DataFrame]:
    """Written tables: doc_id and digest of each row, and digest, group_size and keep_id of each group."""
    spark = docs.sparkSession
    source = narrow(docs, id_col, text_col)
    digests = stage(source.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    if index is None:
        id_type = digests.schema["doc_id"].dataType.simpleString()
        index = DigestIndex(spark, f"{staging_dir(spark)}/digest-index-{uuid.uuid4().hex}", id_type)
    for batch in _batches(digests, batches):
        index.append(batch)
    sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    return digests, stage(sizes.join(index.rows(), "digest"), "digest-groups")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2,
                index: DigestIndex | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Without a given index a new one is made in the shared folder. Ids of earlier batches in a given
    index win over the ids of ``docs``. The last join moves ids and digests only, and adaptive
    execution splits the rows of a digest that many documents share.
    """
    digests, groups = _grouped(docs, id_col, text_col, batches, index)
    return digests.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """The whole rows that stay, one per distinct text, with the columns of ``docs``.

    A filter of the repeated digests tells in the scan which rows are surely alone; they pass as they
    are. Only the others move: by digest and id, so that the rows of a text that many share are spread.
    """
    _, groups = _grouped(docs, id_col, text_col, batches, None)
    bits, words = bloom_filter(groups.where("group_size > 1").select("digest"), "digest")
    staying = groups.where(may_hold(bits, words, F.col("digest")))
    staying = staying.select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep_id"))
    row = [f"c{i}" for i in range(len(docs.columns))]
    given = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, row, strict=True)])
    at_id, at_text = row[docs.columns.index(id_col)], row[docs.columns.index(text_col)]
    keyed = compute_once(given, _text=text_digest(F.col(at_text)))
    suspect = may_hold(bits, words, F.col("_text"))
    same = (F.col("_text") == F.col("_digest")) & F.col(at_id).eqNullSafe(F.col("_keep_id"))
    kept = keyed.where(suspect).join(staying, same, "left_semi")
    one = kept.groupBy("_text").agg(F.max(F.struct(*row)).alias("_row")).select("_row.*")
    both = keyed.where(~suspect).select(*row).unionByName(one)
    return both.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, row, strict=True)])


def op7(docs: DataFrame) -> DataFrame:
    found = deduplicate(docs)
    return found.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
