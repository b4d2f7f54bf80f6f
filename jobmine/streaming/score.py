"""New postings scored as they arrive: no state, no shuffle, exactly once into files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from jobmine.config import Settings
from jobmine.operators.clustering import ClusterModel
from jobmine.plans.score import assign_new, prepare_new
from jobmine.plans.train import FeatureModel


def score_stream(
    stream: DataFrame, features: FeatureModel, model: ClusterModel, out: str, checkpoint: str,
    settings: Settings = Settings(),
) -> StreamingQuery:
    """Score what is there and stop; ``checkpoint`` remembers what was done."""
    scored = assign_new(prepare_new(stream, settings), features, model.centers)
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
