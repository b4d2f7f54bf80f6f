"""Hard negatives by an exact search in a GNAT-style multiway hyperplane tree.

Components are made whole numbers, so a score is a whole inner product. Vectors are lifted by one
coordinate to a common length, which turns a window of scores around an anchor into an annulus of
distances. A node of the tree has up to sixteen split points; a row belongs to the nearest one, and each
split point stores the least and the largest distance to the rows of every sibling subtree. A subtree
is left out for an anchor if, by the triangle inequality, those ranges and the anchor's own distances to
the split points cannot meet its annulus; rows of the leaves that remain are scored exactly.

Split points come from a bounded sample (``SAMPLE`` rows with the smallest hash of their id) and the
tree has at most 4,096 leaves, so it is small whatever the table; every row is indexed and its
distances count in the ranges. Rows are stored by leaf, and a leaf of any size is spread over many
tasks. Anchors are taken in blocks of ``BLOCK``; each block is two passes over the index (positives,
then negatives), in which tasks keep the best few per anchor and narrow the annulus as they go. What a
pass returns is merged by Spark.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component take no
part; shorter vectors count as padded with zeros; a component beyond 2^24 after scaling counts as 2^24.
Repeated rows count as often as they occur, as positives and negatives; an anchor that occurs twice
alike is one anchor. Rows with the anchor's id are never its positives or negatives. A negative positive
score has an empty window. Empty tables give empty results. Other columns may have any names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmine.llm.positions import numbered
from jobmine.session import stage, staging_dir

SCALE = 256
LARGEST = 1 << 24
ANCHOR_STEP = 100
SHIFT_STEP = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 5
LEAST_SHARE = 80  # percent of the positive's score

SAMPLE = 8_192
FANOUT = 16
DEPTH = 3
LEAF_SAMPLE = 24
LEAF_ROWS = 2_048
BLOCK = 8_192
_ROWS = 4_096
_ANCHORS = 512
_OFFERS = 1 << 16
_SLACK = 1e-6
_KINDS = "anchor int, place int, score bigint, vec_id bigint"


@dataclass
class Node:
    points: np.ndarray  # lifted
    below: list[int]  # a node's number, or -1 - the leaf's number
    least: np.ndarray | None = None  # [split point, sibling subtree]
    most: np.ndarray | None = None


@dataclass
class Tree:
    radius: float
    nodes: list[Node] = field(default_factory=list)
    routes: list[list[tuple[int, int]]] = field(default_factory=list)  # per leaf: node and branch, from the root

    def lift(self, rows: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.radius - (rows * rows).sum(1), 0.0))
        return np.hstack([rows, extra[:, None]])


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _split_points(rows: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Distinct rows far from each other, picked one after the other from a few candidates."""
    some = np.unique(rows[draw.permutation(len(rows))[:4 * FANOUT]], axis=0)
    chosen = [int(draw.integers(len(some)))]
    apart = _apart(some, some[chosen])[:, 0]
    while len(chosen) < min(FANOUT, len(some)):
        far = int(apart.argmax())
        if apart[far] <= 0:
            break
        chosen.append(far)
        apart = np.minimum(apart, _apart(some, some[[far]])[:, 0])
    return some[chosen]


def plant(sample: np.ndarray, radius: float, rows: int, leaf_rows: int = LEAF_ROWS, seed: int = 42) -> Tree:
    """The tree of a sample of ``rows`` rows, split where more than ``leaf_rows`` of them are expected;
    ranges are filled in by ``measure``."""
    tree, draw = Tree(radius), np.random.default_rng(seed)
    least = max(LEAF_SAMPLE, leaf_rows * len(sample) / rows)

    def grow(rows: np.ndarray, route: list[tuple[int, int]]) -> int:
        points = _split_points(rows, draw) if len(rows) > least and len(route) < DEPTH else rows[:0]
        if len(points) < 2:
            tree.routes.append(route)
            return -len(tree.routes)
        number = len(tree.nodes)
        tree.nodes.append(Node(points, []))
        near = _apart(rows, points).argmin(1)
        for branch in range(len(points)):
            tree.nodes[number].below.append(grow(rows[near == branch], [*route, (number, branch)]))
        return number

    grow(tree.lift(sample), [])
    return tree


def _descend(tree: Tree, rows: np.ndarray, seen=None) -> np.ndarray:
    """The leaf of each lifted row; ``seen`` gets (node, branch, distances) of the rows that pass."""
    leaf = np.zeros(len(rows), np.int32)
    todo = [(0, np.arange(len(rows)))] if tree.nodes else []
    while todo:
        number, at = todo.pop()
        node = tree.nodes[number]
        apart = _apart(rows[at], node.points)
        near = apart.argmin(1)
        for branch in np.unique(near):
            own = near == branch
            if seen is not None:
                seen(number, branch, apart[own])
            below = node.below[branch]
            if below < 0:
                leaf[at[own]] = -1 - below
            else:
                todo.append((below, at[own]))
    return leaf


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(-1, width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and the whole components ``v`` of the rows that take part."""
    vec_id, vector, label = rows[id_col].cast("long"), rows[vector_col], rows[label_col].cast("int")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * SCALE))).cast("int"))
    moved = F.when(vec_id % SHIFT_STEP == 0, (label + 1) % LABELS).otherwise(label)
    kept = rows.where(vec_id.isNotNull() & label.isNotNull() & vector.isNotNull() & F.coalesce(sound, F.lit(False)))
    return kept.select(vec_id.alias("vec_id"), moved.alias("label"), whole.alias("v"))


@dataclass
class Index:
    """The tree with its ranges, and the rows stored by leaf: leaf, vec_id, label, v."""

    tree: Tree
    rows: DataFrame
    width: int
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, labels, vectors


def build(rows: DataFrame, sample_rows: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> Index | None:
    """``rows`` has vec_id, label and v; None if there are none."""
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    known = rows.agg(F.max(length).alias("radius"), F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("rows")).first()
    if known["radius"] is None:
        return None
    width = max(known["width"], 1)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    some = _matrix(drawn.column("v").combine_chunks(), width)
    tree = plant(some, known["radius"], known["rows"], leaf_rows)

    def assign(batches):
        for batch in batches:
            leaf = _descend(tree, tree.lift(_matrix(batch.column(2), width)))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", "vec_id", "label", "v"])

    placed = rows.select("vec_id", "label", "v").mapInArrow(assign, "leaf int, vec_id bigint, label int, v array<int>")
    order = ["leaf", F.xxhash64("vec_id")]
    stored = stage(placed.repartitionByRange(*order).sortWithinPartitions(*order), "gnat-rows")
    sample = drawn.column("vec_id").to_numpy(), drawn.column("label").to_numpy(), some
    return Index(measure(tree, stored, width), stored, width, sample)


def measure(tree: Tree, stored: DataFrame, width: int) -> Tree:
    """Fill in the ranges from all rows: each task keeps them per node, Spark merges them."""
    def ranges(batches):
        held: dict = {}

        def seen(number, branch, apart):
            low, high = apart.min(0), apart.max(0)
            if (number, branch) in held:
                low, high = np.minimum(low, held[number, branch][0]), np.maximum(high, held[number, branch][1])
            held[number, branch] = low, high

        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                _descend(tree, tree.lift(_matrix(batch.column(0).slice(at, _ROWS), width)), seen)
        out = [(n, i, b, low[i], high[i]) for (n, b), (low, high) in held.items() for i in range(len(low))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["node", "point", "branch", "low", "high"])

    found = stored.select("v").mapInArrow(ranges, "node bigint, point bigint, branch bigint, low double, high double")
    for node in tree.nodes:  # a branch without rows is never met
        node.least = np.full((len(node.points), len(node.points)), np.inf)
        node.most = np.full((len(node.points), len(node.points)), -np.inf)
    for r in found.groupBy("node", "point", "branch").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        node = tree.nodes[r["node"]]  # at most 273 nodes of 256 ranges
        node.least[r["point"], r["branch"]], node.most[r["point"], r["branch"]] = r["low"], r["high"]
    return tree


class Reach:
    """Which scores the rows of a leaf can have with each anchor of a block."""

    def __init__(self, tree: Tree, anchors: np.ndarray):
        self.tree = tree
        self.lengths = (anchors * anchors).sum(1)
        flat = np.hstack([anchors, np.zeros((len(anchors), 1))])  # an anchor as a query is not lifted
        self.apart = [_apart(flat, node.points) for node in tree.nodes]
        self.last, self.found = None, None

    def scores(self, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score, a little too wide rather than too narrow."""
        if self.last != leaf:
            self.last, self.found = leaf, self._scores(leaf)
        return self.found

    def _scores(self, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        near, far = np.zeros(len(self.lengths)), np.full(len(self.lengths), np.inf)
        for number, branch in self.tree.routes[leaf]:
            node, apart = self.tree.nodes[number], self.apart[number]
            low, high = node.least[:, branch], node.most[:, branch]
            near = np.maximum(near, np.maximum(low - apart, apart - high).max(1))
            far = np.minimum(far, (apart + high).min(1))
        slack = _SLACK * (self.lengths + self.tree.radius + 1.0)
        top = self.lengths + self.tree.radius
        return (top - far * far) / 2 - slack, (top - near * near) / 2 + slack


class Best:
    """The first few (by score, then smaller id) of each place, among what was offered so far. Offers
    wait until there are ``_OFFERS`` of them; ``floor`` is the last kept score of a full place."""

    def __init__(self, floor: np.ndarray, few: int):
        self.floor, self.few = floor, few
        self.kept, self.waiting, self.size = tuple(np.zeros(0, np.int64) for _ in range(3)), [], 0

    def offer(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(place):
            self.waiting.append((place, score, ids))
            self.size += len(place)
            if self.size >= _OFFERS:
                self.settle()

    def settle(self) -> None:
        place, score, ids = (np.concatenate(x) for x in zip(self.kept, *self.waiting, strict=True))
        self.waiting, self.size = [], 0
        order = np.lexsort((ids, -score, place))
        place, score, ids = place[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
        few = rank < self.few
        self.kept = place[few], score[few], ids[few]
        full = rank == self.few - 1
        self.floor[place[full]] = np.maximum(self.floor[place[full]], score[full])

    def batch(self, few_per_anchor: int) -> pa.RecordBatch:
        self.settle()
        place, score, ids = self.kept
        return pa.RecordBatch.from_arrays([
            pa.array(place // few_per_anchor, pa.int32()), pa.array(place % few_per_anchor, pa.int32()),
            pa.array(score, pa.int64()), pa.array(ids, pa.int64())], ["anchor", "place", "score", "vec_id"])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _chunks(batches, width: int):
    """leaf, ids, labels and vectors of runs of rows of one leaf."""
    for batch in batches:
        leaves = batch.column(0).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(leaves[1:] != leaves[:-1]) + 1, [len(leaves)]]) if len(leaves) else [0]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            for at in range(a, b, _ROWS):
                n = min(_ROWS, b - at)
                yield (int(leaves[a]), batch.column(1).slice(at, n).to_numpy(), batch.column(2).slice(at, n).to_numpy(),
                       _matrix(batch.column(3).slice(at, n), width))


def _merge(found: DataFrame, few: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def nearest_of_label(index: Index, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, few: int) -> DataFrame:
    """anchor, place 0, score, vec_id, rank of the best rows with the anchor's label and another id."""
    tree, width = index.tree, index.width
    floor = np.full(len(ids), -np.inf)  # a bound from the sample, which holds some of the rows
    for at in range(0, len(ids), _ANCHORS):
        some = slice(at, at + _ANCHORS)
        scores = _products(anchors[some], index.sample[2]).astype(np.float64)
        other = (labels[some, None] != index.sample[1][None, :]) | (ids[some, None] == index.sample[0][None, :])
        scores[other] = -np.inf
        if scores.shape[1] >= few:
            floor[some] = -np.partition(-scores, few - 1, axis=1)[:, few - 1]

    def search(batches):
        reach, best = Reach(tree, anchors), Best(floor.copy(), few)
        for leaf, row_ids, row_labels, rows in _chunks(batches, width):
            alive = np.flatnonzero(reach.scores(leaf)[1] >= best.floor)
            for label in np.intersect1d(labels[alive], row_labels):
                own, at = alive[labels[alive] == label], np.flatnonzero(row_labels == label)
                for a in range(0, len(own), _ANCHORS):
                    some = own[a:a + _ANCHORS]
                    scores = _products(rows[at], anchors[some])
                    r, c = np.nonzero((scores >= best.floor[some]) & (row_ids[at][:, None] != ids[some]))
                    best.offer(some[c], scores[r, c], row_ids[at][r])
        yield best.batch(1)

    return _merge(index.rows.mapInArrow(search, _KINDS), few)


def below_positives(index: Index, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, positive: np.ndarray, few: int) -> DataFrame:
    """anchor, place (of the positive), score, vec_id, rank of the best rows of other labels within the
    window of each positive. ``positive`` has a row of scores per anchor, NaN where there is none."""
    tree, width, places = index.tree, index.width, positive.shape[1]
    low = np.where(positive >= 0, np.ceil(np.nan_to_num(positive) * LEAST_SHARE / 100 - 1e-9), np.inf)
    high = np.where(positive >= 0, positive, -np.inf)

    def search(batches):
        reach, best, top = Reach(tree, anchors), Best(low.ravel().copy(), few), high.max(1)
        for leaf, row_ids, row_labels, rows in _chunks(batches, width):
            least, most = reach.scores(leaf)
            alive = np.flatnonzero((most >= best.floor.reshape(-1, places).min(1)) & (least <= top))
            for a in range(0, len(alive), _ANCHORS):
                some = alive[a:a + _ANCHORS]
                scores = _products(rows, anchors[some])
                floors = best.floor.reshape(-1, places)
                r, c = np.nonzero((scores >= floors[some].min(1)) & (scores <= top[some]))
                other = (row_labels[r] != labels[some[c]]) & (row_ids[r] != ids[some[c]])
                r, owner, score = r[other], some[c[other]], scores[r[other], c[other]]
                at, place = np.nonzero((score[:, None] >= floors[owner]) & (score[:, None] <= high[owner]))
                best.offer(owner[at] * places + place, score[at], row_ids[r[at]])
        yield best.batch(places)

    return _merge(index.rows.mapInArrow(search, _KINDS), few)


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _block(spark: SparkSession, index: Index, anchors: pa.Table, positives: int, negatives: int) -> DataFrame:
    ids, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
    matrix = _matrix(anchors.column("v").combine_chunks(), index.width)
    near = nearest_of_label(index, ids, labels, matrix, positives).select("anchor", "rank", "score", "vec_id").toArrow()
    at = near.column("anchor").to_numpy(), near.column("rank").to_numpy() - 1  # BLOCK times positives numbers
    scores = np.full((len(ids), positives), np.nan)
    scores[at] = near.column("score").to_numpy()
    found = below_positives(index, ids, labels, matrix, scores, negatives)
    pairs = spark.createDataFrame(pa.table({
        "_anchor": pa.array(at[0], pa.int32()), "_place": pa.array(at[1], pa.int32()), "anchor_id": pa.array(ids[at[0]], pa.int64()),
        "positive_id": near.column("vec_id"), "positive_score": near.column("score")}))
    joined = found.join(F.broadcast(pairs), (found["anchor"] == pairs["_anchor"]) & (found["place"] == pairs["_place"]))
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                         "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK, sample_rows: int = SAMPLE,
         leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per anchor and positive the first negatives within the window, ranked from 1."""
    spark = rows.sparkSession
    whole = stage(vectors(rows, id_col, vector_col, label_col), "whole-vectors")
    index = build(whole, sample_rows, leaf_rows)
    if index is None:
        return spark.createDataFrame([], SCHEMA)
    alike = whole.where(F.col("vec_id") % ANCHOR_STEP == 0).distinct()
    anchors = stage(numbered(alike, [], ["vec_id", "label", "v"], "anchors-in-order"), "anchors")
    total = anchors.count()
    path = f"{staging_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    for start in range(0, total, block):
        some = anchors.where((F.col("idx") >= start) & (F.col("idx") < start + block)).select("vec_id", "label", "v").toArrow()
        _block(spark, index, some, positives, negatives).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path) if total else spark.createDataFrame([], SCHEMA)


def op12(rows: DataFrame) -> DataFrame:
    return mine(rows)


OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id, list_inner_product(a.v, o.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM vectors WHERE vec_id % 100 = 0) a JOIN vectors o ON o.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""
