"""Places of rows in a global order, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmine.session import stage

_ROW_BITS = 33  # of a number by monotonically_increasing_id, below the partition's number


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Append ``idx``, the place of a row in its group from 0, and ``size``, the rows of the group.

    Rows are dealt by ranges of (group, order) and sorted within them, so a group of any size is
    spread over many tasks; places follow from the first row of each group in each range. Nulls come
    first. ``order`` should tell rows apart: rows alike in all of it share a task.
    """
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    runs = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in group], part).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy(*[f"_{c}" for c in group])  # a row per range of the group
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.select(
        *[f"_{c}" for c in group], F.col("_part").alias("_in"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(own).alias("size"),
    )
    same = F.shiftright(rows["_at"], _ROW_BITS) == placed["_in"]
    for c in group:
        same = same & rows[c].eqNullSafe(placed[f"_{c}"])
    return rows.join(placed, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "size")
