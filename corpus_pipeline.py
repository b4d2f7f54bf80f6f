"""A corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``, each time whole rows. Near copies are taken on five-word
shingles with a similarity of 0.8 or more. Rows are dropped for these reasons only:

- ``language``: the text has no letter, or scores far below what labelled texts of its length and
  language do (all labelled rows teach; without any, every text with a letter stays);
- ``exact_dedup``: an equal text with a larger id stays;
- ``near_dedup``: a document of the same group with a smaller id stays;
- ``decontaminate``: the text holds a benchmark item.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmine.llm import decontamination, exact_dedup, language_id, near_dedup, packing
from jobmine.llm.common import matching, small_batches
from jobmine.session import stage, staging_dir

SHINGLE = 5
PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = language_id.learn(language_id.labelled(docs))
    return language_id.keep_known(docs, profiles)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        found = near_dedup.near_duplicates(docs, shingle=SHINGLE, percent=PERCENT)
        kept = stage(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-kept")
    return matching(docs, kept, "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Profiles, sketches and packing are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for at, (name, function) in enumerate(STAGES):
        out = function(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = f"{folder}/{at}-{name}"
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        docs = out
    return docs
