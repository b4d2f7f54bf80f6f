"""A store of versions: tables that belong together, valid as a whole or not at all.

Every write goes into fresh folders; a manifest row that names them is appended last, as one file.
Until then readers see the version before, so a crash between two tables leaves no mixed state, and
folders that no manifest row names are only garbage. Tables with a key are bucketed and sorted by it
with the same number of buckets, so that joining them again needs no shuffle.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = (
    "version long, commit string, parts array<struct<name: string, folder: string, rows: long, "
    "fields: string, key: string, buckets: int>>"
)


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the committed versions, ascending."""
    manifest = _manifest(spark, path)
    return [] if manifest is None else sorted(r["version"] for r in manifest.select("version").distinct().collect())


def write_version(
    parts: dict[str, DataFrame], path: str, key: str | None = None, buckets: int | None = None
) -> int:
    """Write tables as the next version and return its number.

    Tables that have a ``key`` column are bucketed by it, in ``buckets`` files (as many as the
    session's shuffle partitions by default). Row counts are taken while writing. Of two writers
    that commit the same number at once, readers take the larger commit name, whole.
    """
    spark = next(iter(parts.values())).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = max(versions(spark, path), default=0) + 1
    commit = uuid.uuid4().hex
    rows = []
    for name, df in parts.items():
        keyed = key is not None and key in df.columns
        folder = f"{version}-{commit}/{name}"
        seen = Observation(f"{name}-{commit}")
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if keyed:
            table = f"store_{uuid.uuid4().hex}"
            dealt = observed.repartition(buckets, key)  # a file per bucket
            dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option(
                "path", f"{path}/{folder}"
            ).saveAsTable(table)
            spark.sql(f"DROP TABLE {table}")  # the files stay
        else:
            observed.write.parquet(f"{path}/{folder}")
        rows.append((name, folder, seen.get["rows"], df.schema.json(), key if keyed else None, buckets if keyed else None))
    manifest = spark.createDataFrame([(version, commit, rows)], MANIFEST)
    manifest.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the latest by default. Raises if there is none.

    Bucketed tables are registered in the session's catalog under a name made from their folder, so
    a second read finds them there; ``forget`` removes the names.
    """
    manifest = _manifest(spark, path)
    if manifest is not None and version is not None:
        manifest = manifest.where(F.col("version") == version)
    last = None if manifest is None else manifest.orderBy(F.desc("version"), F.desc("commit")).first()
    if last is None:
        raise FileNotFoundError(f"no version {version or ''} in {path}")
    found = {}
    for part in last["parts"]:
        schema, place = StructType.fromJson(json.loads(part["fields"])), f"{path}/{part['folder']}"
        if part["key"] is None:
            found[part["name"]] = spark.read.schema(schema).parquet(place)
            continue
        table = _table(last["commit"], part["name"])
        quoted = place.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{table}` ({schema.toDDL()}) USING parquet "
            f"CLUSTERED BY (`{part['key']}`) SORTED BY (`{part['key']}`) INTO {part['buckets']} BUCKETS "
            f"LOCATION '{quoted}'"
        )
        found[part["name"]] = spark.table(f"`{table}`")
    return found


def forget(spark: SparkSession, path: str) -> None:
    """Remove the names that ``read_version`` registered; the files stay."""
    manifest = _manifest(spark, path)
    for row in [] if manifest is None else manifest.collect():
        for part in row["parts"]:
            if part["key"] is not None:
                spark.sql(f"DROP TABLE IF EXISTS `{_table(row['commit'], part['name'])}`")


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """(version, name, rows) of every committed table, from the manifest alone."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], "version long, name string, rows long")
    return manifest.select("version", F.inline("parts")).select("version", "name", "rows")


def _table(commit: str, name: str) -> str:
    return f"store_{commit}_{name}".lower()
