"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

A text becomes a fixed number of statistics (lengths, shares of kinds of characters, repetition),
transformed to be roughly symmetric and standardised on the training rows. Each class has a mean and
a covariance, shrunk towards the pooled covariance and towards a multiple of the identity; the
score is the posterior of label 1 from the difference of the two log-densities, taken from
Mahalanobis distances by Cholesky factors that are computed once and sent to the tasks.

Class means and covariances are sums over all labelled training rows, added up by Spark; only these
sums (a few hundred numbers) reach the driver.

Defined cases: null and empty texts are scored as empty ones; an id with several labels counts once
with each; labels that are null or neither 0 nor 1 are ignored; with no training rows every score is
0.5, with one class only it is that class's (0 or 1, kept off the ends). Repeated rows are scored
each. Other columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmine.llm.arrow_text import slices, span_hashes, word_bounds
from jobmine.llm.common import fold, narrow
from jobmine.session import stage

FEATURES = (
    "log_bytes", "word_length", "word_length_spread", "upper", "digit", "inner_mark", "symbol",
    "word_end_mark", "bar", "distinct_words", "repeated_lines", "line_length", "other_script",
)
THRESHOLD = 0.3
SHRINK_POOLED = 0.1
SHRINK_IDENTITY = 0.05


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 other, 1 upper, 2 lower, 3 digit, 4 sentence mark, 5 symbol, 6 bar, 7 beyond ASCII, 8 space."""
    kind = np.full(256, 5, np.uint8)
    kind[0:33] = 0
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 7
    kind[[ord(c) for c in ".,;:'\"()-"]] = 4
    kind[ord("|")] = 6
    kind[9:14] = kind[32] = 8
    return kind


_KINDS = _kinds()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Number of different hashes per row."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=rows)


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of transformed statistics per text, in the order of ``FEATURES``."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds).astype(float)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    kinds = _KINDS[data]
    counts = np.bincount(owner * 16 + kinds, minlength=rows * 16).reshape(rows, 16).astype(float)
    starts, ends = word_bounds(data, bounds)
    of = owner[starts]
    lengths = (ends - starts).astype(float)
    words = np.bincount(of, minlength=rows).astype(float)
    mean = _share(np.bincount(of, lengths, minlength=rows), words)
    spread = np.sqrt(np.maximum(_share(np.bincount(of, lengths**2, minlength=rows), words) - mean**2, 0))
    last = kinds[ends - 1]
    marked = np.bincount(of[(last == 5) | (last == 6)], minlength=rows)
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([bounds[:-1][sizes > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_of = owner[line_start]
    lines = np.bincount(line_of, minlength=rows).astype(float)
    once = _distinct(span_hashes(data, line_start, line_end), line_of, rows)
    kinds_of_word = _distinct(span_hashes(data, starts, ends), of, rows)
    letters = counts[:, 1] + counts[:, 2] + counts[:, 7]
    table = [
        np.log1p(sizes),
        np.log1p(mean),
        np.log1p(spread),
        np.sqrt(_share(counts[:, 1], letters)),
        np.sqrt(_share(counts[:, 3], sizes)),
        np.sqrt(_share(counts[:, 4], sizes)),
        np.sqrt(_share(counts[:, 5], sizes)),
        np.sqrt(_share(marked, words)),
        np.sqrt(_share(counts[:, 6], sizes)),
        _share(kinds_of_word, words),
        np.sqrt(1 - _share(once, np.maximum(lines, 1)) * (lines > 0) - (lines == 0)),
        np.log1p(_share(sizes, np.maximum(lines, 1))),
        np.sqrt(_share(counts[:, 7], letters)),
    ]
    return np.stack(table, 1)


@dataclass
class Discriminant:
    """Standardisation, and per class log prior, mean, inverse Cholesky factor and log determinant."""

    center: np.ndarray
    scale: np.ndarray
    classes: dict[int, tuple[float, np.ndarray, np.ndarray, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), 0.5)
        if len(self.classes) == 1:
            return np.full(len(x), 0.999 if 1 in self.classes else 0.001)
        z = (x - self.center) / self.scale
        logs = []
        for k in (0, 1):
            prior, mean, inverse, logdet = self.classes[k]
            apart = (z - mean) @ inverse.T
            logs.append(prior - 0.5 * (apart**2).sum(1) - 0.5 * logdet)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and x (its statistics) for every row; ``docs`` has doc_id and text."""

    def measure(batches):
        for batch in batches:
            for a, b, data, bounds in slices(batch.column(1)):
                x = statistics(data, bounds)
                ends = np.arange(0, x.size + 1, x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.ravel()))],
                    ["doc_id", "x"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return docs.select("doc_id", "text").mapInArrow(measure, schema)


def fit(labelled: DataFrame, pooled: float = SHRINK_POOLED, identity: float = SHRINK_IDENTITY) -> Discriminant:
    """The discriminant from rows of x and label (0 or 1): one pass of sums per class."""
    size = len(FEATURES)

    def add(batches):
        sums = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x = np.asarray(pc.list_flatten(batch.column(0))).reshape(-1, size)
            label = np.asarray(batch.column(1))
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        flat = [(k, i, float(v)) for k in (0, 1) for i, v in enumerate(sums[k])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], pa.int32()),
             pa.array([r[2] for r in flat], pa.float64())], ["label", "place", "v"])

    parts = labelled.select("x", F.col("label").cast("int").alias("label")).mapInArrow(add, "label int, place int, v double")
    totals = np.zeros((2, 1 + size + size * size))
    for row in parts.groupBy("label", "place").agg(F.sum("v").alias("v")).collect():  # a few hundred numbers
        totals[row["label"], row["place"]] = row["v"]
    n = totals[:, 0]
    if n.sum() == 0:
        return Discriminant(np.zeros(size), np.ones(size), {})
    center = totals[:, 1:1 + size].sum(0) / n.sum()
    second = totals[:, 1 + size:].reshape(2, size, size)
    scale = np.sqrt(np.maximum(np.diag(second.sum(0)) / n.sum() - center**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    means, scatters = {}, {}
    for k in (0, 1):
        if n[k]:
            mean = totals[k, 1:1 + size] / n[k]
            scatters[k] = (second[k] - n[k] * np.outer(mean, mean)) / np.outer(scale, scale)
            means[k] = (mean - center) / scale
    whole = sum(scatters.values()) / n.sum()
    classes = {}
    for k in means:
        own = (1 - pooled) * scatters[k] / n[k] + pooled * whole
        own = (1 - identity) * own + identity * np.eye(size) * max(np.trace(own) / size, 1e-6)
        factor = np.linalg.cholesky(own)
        prior = float(np.log(n[k] / n.sum()))
        classes[k] = (prior, means[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(center, scale, classes)


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of rows of doc_id and x."""

    def apply(batches):
        for batch in batches:
            x = np.asarray(pc.list_flatten(batch.column(1))).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    schema = T.StructType([measured.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return measured.select("doc_id", "x").mapInArrow(apply, schema)


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measured = stage(features(narrow(docs)), "statistics")
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).where("label IN (0, 1)")
    training = measured.where(~fold(F.col("doc_id"), 5, 0)).join(known, F.col("doc_id") == F.col("_id"))
    scored = score(measured, fit(training))
    return scored.select("doc_id", fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
