"""Session helpers: a local session for tests and the bench, and shared staging storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "jobmine", cpus: str = "8", memory: str = "12g") -> SparkSession:
    """A single-machine session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster an unset folder is an
    error, because a machine-local path would not survive the loss of an executor.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="jobmine-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def stage(df: DataFrame, label: str, **options: object) -> DataFrame:
    """Write ``df`` as parquet in the shared folder, with the writer's ``options``, and read it back.

    Cuts the lineage and lets the following steps prune columns and push filters, instead of
    computing the same expressions once per consumer.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20, rows: int | None = None) -> Iterator[None]:
    """Arrow batches of at most ``size`` bytes for the jobs run inside, and if given at most ``rows``
    rows decoded at once by the parquet reader; long rows need less memory."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    if rows is not None:
        wanted["spark.sql.parquet.columnarReaderBatchSize"] = str(rows)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def limit_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Lower the session's limit for Arrow batches to ``size`` bytes, if it is higher; for steps that run later,
    whose rows hold so many words that a batch of thousands of them fills what an executor has beside its heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > size:
        spark.conf.set(key, str(size))
