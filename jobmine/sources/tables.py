"""Reading and writing tables, records and features. Models are tables too: see their ``table``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobmine.config import TEXT_COLUMNS
from jobmine.functions.text import UNKNOWN
from jobmine.operators import gates
from jobmine.session import stage
from jobmine.sources import store

MB = 1 << 20
# Long texts hold line breaks, quotes, commas and blanks at their ends; all are kept.
CSV = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _head(df: DataFrame, limit: int | None, order: str | None) -> DataFrame:
    if limit is None:
        return df
    return df.orderBy(order).limit(limit) if order else df.limit(limit)


def read_table(
    spark: SparkSession, path: str, limit: int | None = None, order: str | None = None
) -> DataFrame:
    """Parquet table, or its first rows; ``order`` makes the head reproducible."""
    return _head(spark.read.parquet(path), limit, order)


def read_csv_table(
    spark: SparkSession, path: str, schema: StructType | str, limit: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """CSV with a header, as ``write_csv`` makes it; a blank cell is null."""
    df = spark.read.options(**CSV).csv(path, schema=schema, multiLine=True, mode="FAILFAST")
    return _head(df, limit, order)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).options(**CSV).csv(path)


def tenth(limit: int | None) -> int | None:
    """A tenth of the train limit, at least one row."""
    return None if limit is None else max(1, limit // 10)


def spread(df: DataFrame, path: str) -> DataFrame:
    """Give every core work when a small input has fewer row groups than cores.

    Regular-expression work is bound by CPU. The size is read from file metadata; a table that
    fills the cores by itself is returned as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= 2 * cores:
        return df
    files = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return df.repartition(cores) if files < cores * 32 * MB else df


def ensure_base_columns(
    df: DataFrame, columns: Sequence[str] = (*TEXT_COLUMNS, "salary"), order: Sequence[str] = ()
) -> DataFrame:
    """Add missing text columns as ``unknown`` and a missing ``id`` as 1..n in the given order.

    Without an order rows are numbered as Spark reads them. The numbering never sorts the table in
    one task: rows are counted per range partition and numbered from the partition's offset.
    """
    missing = {c: F.lit(UNKNOWN) for c in columns if c not in df.columns}
    result = df.withColumns(missing) if missing else df
    if "id" in df.columns:
        return result
    ordered = result.sort(*order) if order else result
    placed = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return numbered.select(*result.columns, (F.col("_offset") + within + 1).alias("id"))


def write_split(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One dataset with a folder per split; other names for a split are reads, not copies."""
    if fmt == "csv":
        write_csv(df, path, ["split"])
    else:
        df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(
    spark: SparkSession, path: str, split: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """One split of ``write_split``; only its folder is scanned. CSV needs the schema of the rows."""
    if fmt == "csv":
        return read_csv_table(spark, f"{path}/split={split}", schema)
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def write_audit(tables: dict[str, DataFrame], path: str) -> None:
    """Each report table as CSV, in as many files as it has partitions: some list every flagged row."""
    for name, table in tables.items():
        write_csv(table, f"{path}/{name}")


def write_json_record(df: DataFrame, path: str) -> None:
    """Settings or scores as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_features(features: DataFrame, path: str) -> None:
    """Weights in long form or ``id, features``; keyed by id, never by position."""
    features.write.mode("overwrite").parquet(path)


def load_feature_set(
    spark: SparkSession, features_path: str, metadata_path: str, width: int, id_col: str = "id"
) -> DataFrame:
    """Features joined to their metadata; raises when a part is missing or ids differ."""
    features = spark.read.parquet(features_path)
    metadata = spark.read.parquet(metadata_path)
    gates.require(gates.features_sound(features, metadata, width, id_col))
    return metadata.join(features, id_col)


def write_feature_set(
    features: DataFrame, metadata: DataFrame, path: str, id_col: str = "id", buckets: int | None = None
) -> int:
    """Features and metadata as one version, bucketed alike by id. Returns the version."""
    return store.write_version({"features": features, "metadata": metadata}, path, id_col, buckets)


def read_feature_set(
    spark: SparkSession, path: str, width: int, id_col: str = "id", version: int | None = None
) -> DataFrame:
    """Features joined to their metadata bucket by bucket: rows are not shuffled. Raises like
    ``load_feature_set``."""
    parts = store.read_version(spark, path, version)
    gates.require(gates.features_sound(parts["features"], parts["metadata"], width, id_col))
    return parts["metadata"].join(parts["features"], id_col)
