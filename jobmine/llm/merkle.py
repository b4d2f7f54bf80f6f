"""Merkle manifest of a dataset: every row proves that it belongs to a published root.

Rows are leaves; the leaves of a group, by id, are joined run by run until one node remains, and the
groups' last nodes, by group, are joined likewise. A level is one equijoin of its nodes with
themselves on computed sibling places (the place XOR 1 for two per run, else the other slots of the
run), then the rows in slot zero emit the parents. Proofs go the other way: each level is joined with
the paths of its parents, so a level moves as many rows as it has nodes and no leaf looks up every
level. Levels are written as tables, which are the manifest.

Defined cases: a null value is ``-`` and an empty one ``0:``, so they differ; a null group is a group of
its own and comes first; null ids come first; rows with equal ids are ordered by their leaf, and rows
alike in all columns are separate, equal leaves. A lone leaf is its group's last node, a lone group's
last node is the root. An empty table has no rows and the root None. Texts are hashed whole, in the
JVM, whatever their length. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmine.llm.common import union_all
from jobmine.llm.positions import numbered
from jobmine.operators.rows import small_side
from jobmine.session import stage

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_PARTS = 7
JOINS_AT_ONCE = 6  # levels whose joins are planned together


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, _hex), "")


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: each value with its length in UTF-8 bytes, or ``-`` if null."""
    return _digest(F.concat(*[_field(c) for c in fields]))


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Append ``slot``, ``others`` (the run's other nodes, left to right) and, in slot zero, ``parent``."""
    slot = F.col("idx") % fanout
    out, found = nodes, []
    for offset in range(1, fanout):
        target = F.col("idx").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("idx") - slot + (slot + offset) % fanout
        peer = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("node").alias(f"_node{offset}"))
        out = out.withColumn("_target", target).join(
            peer, (F.col("tree") == F.col("_tree")) & (F.col("_target") == F.col("_idx")), "left").drop("_tree", "_idx", "_target")
        found.append(F.struct(((slot + offset) % fanout).alias("slot"), F.col(f"_node{offset}").alias("node")))
    present = F.array_sort(F.filter(F.array(*found), lambda x: x["node"].isNotNull()))
    out = out.select(*nodes.columns, slot.cast("int").alias("slot"), F.transform(present, lambda x: x["node"]).alias("others"))
    parent = _digest(F.concat(_hex(F.col("node")), _joined(F.col("others"))))
    return out.withColumn("parent", F.when(F.col("slot") == 0, parent))


@dataclass(frozen=True)
class Forest:
    """Trees of one fan-out: a table per level with tree, idx, node, slot, others and parent (level 0
    also with what the leaves carry), the leaves that are alone in their tree, and tree, node of the
    last nodes."""

    levels: list[DataFrame]
    alone: DataFrame
    roots: DataFrame


def grow(leaves: DataFrame, fanout: int = 2) -> Forest:
    """``leaves`` has tree (not null), idx from 0, size (nodes of the tree) and node, and may have more."""
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    largest = leaves.agg(F.max("size")).first()[0] or 0
    levels, roots, nodes = [], [leaves.where("size = 1").select("tree", "node")], leaves
    while largest > 1:
        level = stage(_siblings(nodes.where("size > 1"), fanout), f"merkle-{len(levels)}")
        levels.append(level)
        nodes = level.where("slot = 0").select(
            "tree", F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
            F.col("parent").alias("node"))
        roots.append(nodes.where("size = 1").select("tree", "node"))
        largest = -(-largest // fanout)
    return Forest(levels, leaves.where("size = 1"), stage(union_all(roots), "merkle-roots"))


def paths(forest: Forest, keep: Sequence[str], fanout: int = 2) -> DataFrame:
    """Per leaf ``tree``, ``keep`` and ``path``: slot and siblings of each level, from the leaf up."""
    known = None
    for at in range(len(forest.levels) - 1, -1, -1):
        level = forest.levels[at]
        step = F.array(F.struct("slot", "others"))
        carried = [F.col(c) for c in keep] if at == 0 else []
        if known is None:
            known = level.select("tree", "idx", *carried, step.alias("path"))
            continue
        above = known.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"))
        same = (F.col("tree") == F.col("_tree")) & (F.col("_up") == F.col("_idx"))
        path = F.when(F.col("_path").isNull(), step).otherwise(F.concat(step, F.col("_path")))
        known = level.withColumn("_up", F.expr(f"idx div {fanout}")).join(above, same, "left").select(
            "tree", "idx", *carried, path.alias("path"))
        if at and at % JOINS_AT_ONCE == 0:
            known = stage(known, "merkle-paths")
    empty = F.array().cast("array<struct<slot:int,others:array<binary>>>")
    alone = forest.alone.select("tree", *keep, empty.alias("path"))
    return alone if known is None else known.drop("idx").unionByName(alone)


def fold(start: Column, path: Column) -> Column:
    """The root, in hex, that a leaf (in hex) and its path lead to."""
    def up(node: Column, step: Column) -> Column:
        others, slot = step["others"], step["slot"]
        left = _joined(F.slice(others, F.lit(1), slot))
        right = _joined(F.slice(others, slot + 1, F.size(others)))
        return F.sha2(F.concat(left, node, right).cast("binary"), 256)

    return F.aggregate(path, start, up)


@dataclass(frozen=True)
class Manifest:
    """Trees of the groups, the tree over their last nodes, and the root in hex."""

    groups: Forest
    top: Forest
    root: str | None
    fanout: int

    def proofs(self, keep: Sequence[str] = ()) -> DataFrame:
        """Per row what its leaf carries, the hex ``leaf``, ``subroot`` and the whole ``path``."""
        above = paths(self.top, ["group", "node"], self.fanout).select(
            F.col("group").alias("_group"), _hex(F.col("node")).alias("subroot"), F.col("path").alias("_above"))
        own = paths(self.groups, [*keep, "node"], self.fanout)
        tops = small_side(stage(above, "merkle-top"))
        return own.join(tops, own["tree"] == tops["_group"]).select(
            *keep, _hex(F.col("node")).alias("leaf"), "subroot", F.concat("path", "_above").alias("path"))


def build(leaves: DataFrame, order: Sequence[str], fanout: int = 2) -> Manifest:
    """``leaves`` has tree (not null), node and the columns of ``order``, and may have more."""
    placed = stage(numbered(leaves, ["tree"], order, "merkle-leaves"), "merkle-placed")
    groups = grow(placed, fanout)
    subroots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node")
    top = grow(stage(numbered(subroots, ["tree"], ["group"], "merkle-groups"), "merkle-subroots"), fanout)
    last = top.roots.first()
    return Manifest(groups, top, None if last is None else bytes(last["node"]).hex(), fanout)


def tree_key(group: Column) -> Column:
    """A group as text that is never null and sorts as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def op13(docs: DataFrame, fanout: int = 2) -> DataFrame:
    doc_id, source, lang, n_chars, text = [docs[c] for c in COLUMNS]
    tampers = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPER_PARTS == 0, F.lit(False))
    more = F.when(tampers, n_chars.cast("decimal(38,0)") + 1).otherwise(n_chars.cast("decimal(38,0)"))
    leaves = stage(docs.select(
        tree_key(lang).alias("tree"), doc_id.alias("doc_id"), leaf([doc_id, source, lang, n_chars, text]).alias("node"),
        leaf([doc_id, source, lang, more, text]).alias("shown"), F.monotonically_increasing_id().alias("row"),
    ), "merkle-rows")
    manifest = build(leaves, ["doc_id", "node", "row"], fanout)
    found = manifest.proofs(["doc_id", "shown"])
    siblings = F.flatten(F.transform("path", lambda step: step["others"]))
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2(_joined(siblings).cast("binary"), 256).alias("proof_sha256"),
        fold(_hex(F.col("shown")), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = """
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(shown::VARCHAR) || ':' || shown, '-') || tail) AS shown,
         row_number() OVER same - 1 AS idx, count(*) OVER (PARTITION BY lang) AS size
  FROM (SELECT *, n_chars::HUGEINT + (xor(crc, 4294967295) % 7 = 0)::INT AS shown FROM hashed)
  WINDOW same AS (PARTITION BY lang ORDER BY doc_id)),
nodes AS (
  SELECT lang, 0 AS lvl, idx, size, leaf AS node FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, (any_value(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY idx))
  FROM nodes WHERE size > 1 GROUP BY lang, lvl, idx // 2),
subroots AS (
  SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS lvl, idx, size, node FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (any_value(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY idx))
  FROM tops WHERE size > 1 GROUP BY lvl, idx // 2),
walk AS (
  SELECT doc_id, lang, leaf, 0 AS lvl, idx, size, shown AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.lang, w.leaf, w.lvl + 1, w.idx // 2, (w.size + 1) // 2,
         sha256(CASE WHEN w.idx % 2 = 0 THEN folded || coalesce(s.node, '') ELSE s.node || folded END),
         proof || coalesce(s.node, '')
  FROM walk w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.idx = xor(w.idx, 1)
  WHERE w.size > 1),
climb AS (
  SELECT w.doc_id, w.leaf, r.node AS subroot, 0 AS lvl, r.idx, r.size, w.folded, w.proof
  FROM walk w JOIN subroots r ON r.lang IS NOT DISTINCT FROM w.lang WHERE w.size = 1
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.lvl + 1, w.idx // 2, (w.size + 1) // 2,
         sha256(CASE WHEN w.idx % 2 = 0 THEN folded || coalesce(s.node, '') ELSE s.node || folded END),
         proof || coalesce(s.node, '')
  FROM climb w LEFT JOIN tops s ON s.lvl = w.lvl AND s.idx = xor(w.idx, 1)
  WHERE w.size > 1)
SELECT doc_id, leaf, subroot, (SELECT node FROM tops WHERE size = 1) AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = (SELECT node FROM tops WHERE size = 1) AS verified
FROM climb WHERE size = 1"""
