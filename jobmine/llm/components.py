"""Connected components of an edge table, by neighbour minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmine.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node each node of ``edges`` (columns a, b) is connected with.

    Every round takes the smallest label around a node and then the label of that label; rounds are
    written to the shared folder, so lineage stays short. Nothing but a count reaches the driver.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(
            F.min("comp").alias("m"))
        near = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        near = stage(near, "labels")
        jump = near.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        after = near.join(jump, near["comp"] == jump["via"]).select(
            "node", F.least("comp", "far").alias("comp"), "old")
        after = stage(after, "labels")
        if after.where("comp <> old").isEmpty():
            return after.select("node", "comp")
        labels = after.select("node", "comp")
