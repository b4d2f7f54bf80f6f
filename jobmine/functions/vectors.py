"""Array-of-double vectors: norms, slices and distances to a few fixed points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType


def norm(col: Column) -> Column:
    return F.sqrt(F.aggregate(col, F.lit(0.0), lambda total, x: total + x * x))


def l2_normalize(vector: Column, length: Column) -> Column:
    """Unit vector, given the vector's norm; a zero vector stays as it is."""
    return F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector)


def drop_first(vector: Column) -> Column:
    """Remove the leading component of vectors wider than one."""
    return F.when(F.size(vector) > 1, F.slice(vector, F.lit(2), F.size(vector))).otherwise(vector)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A batch of equally long lists as a two-dimensional array, without copying per row."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(vectors), width)


def squared_distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    cross = points @ centers.T
    lengths = (points**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1)[None, :]
    return np.maximum(lengths - 2.0 * cross, 0.0)


def nearest(vector: Column, centers: np.ndarray) -> Column:
    """Struct of the nearest center's ``index`` (ties: the lowest) and the ``squared`` distance to
    it. ``centers`` is k by width."""
    @F.arrow_udf(StructType([StructField("index", IntegerType()), StructField("squared", DoubleType())]))
    def find(vectors: pa.Array) -> pa.Array:
        points = matrix(vectors, centers.shape[1])
        index = squared_distances(points, centers).argmin(axis=1)
        squared = ((points - centers[index]) ** 2).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(index, pa.int32()), pa.array(squared)], names=["index", "squared"]
        )

    return find(vector)


def squared_distance_to(vector: Column, index: Column, centers: np.ndarray) -> Column:
    """Squared distance to the center with the given index, by plain differences."""
    @F.arrow_udf(DoubleType())
    def measure(vectors: pa.Array, indices: pa.Array) -> pa.Array:
        own = centers[indices.to_numpy(zero_copy_only=False)]
        return pa.array(((matrix(vectors, centers.shape[1]) - own) ** 2).sum(axis=1))

    return measure(vector, index)
