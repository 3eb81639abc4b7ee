"""Merkle manifest of a table, with one persistent version for each tampered row.

Each row is a leaf: the SHA-256 of its fields, each as ``-`` if null, else byte
count, colon, value. The leaves of a group stand in the order of their id; while
a group has several nodes, every 16 in a row become their parent, the SHA-256 of
their digests as hexadecimal text. What remains is the group's subroot, and the
subroots, in the order of the groups, are joined to the root likewise.

The tree is built from aligned blocks of ``SPAN`` = 16 ** 3 nodes. A block is one
small row: its nodes in order. Its top three levels are computed by one task, its
top node goes to the next round, which has a 4096th of the nodes, until every
group has one node left; the subroots then go through the same rounds. No task
sees more than one block, so a group may hold any share of the rows.

Versions are persistent: a tampered leaf makes a version of the tree that shares
every node with the untampered tree but the leaf's ancestors. Within its block
the version copies the path from the leaf to the block's top, at most three
nodes; the version goes on in the block above, and so on to its own root.
Only the path that leads up from a block travels back to it (one row a block:
left and right siblings of each level), and all versions of the block copy
their further ancestors along it where they are.

Defined results: rows that share an id stand in the order of their leaves (equal
leaves are equal rows, whose proofs may differ by place); null ids come first;
a null group is a group, the first; a null text has nothing to tamper with;
groups of one leaf have it as subroot, a single group's subroot is the root;
an empty table has no rows. Texts of any length are hashed by Spark. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, written

#: Children of a node, levels of a block, and nodes of a block.
WIDTH = 16
LEVELS = 3
SPAN = WIDTH**LEVELS
#: Rows of results made at a time.
ROWS = 512

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The leaf of a row with these values."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(nodes: str) -> str:
    return hashlib.sha256(nodes.encode()).hexdigest()


def levels_above(n: int) -> int:
    """Levels over ``n`` nodes up to one node."""
    levels = 0
    while n > 1:
        n, levels = -(-n // WIDTH), levels + 1
    return levels


class Block:
    """Up to ``SPAN`` nodes in a row, of a level with ``n`` nodes in all, and the levels over them."""

    def __init__(self, nodes: list[str], n: int):
        self.levels = [nodes]
        for _ in range(min(LEVELS, levels_above(n))):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + WIDTH])) for i in range(0, len(below), WIDTH)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[str, str]]:
        """Siblings to the left and to the right of the node at ``at`` and of its ancestors in the block."""
        out = []
        for nodes in self.levels[:-1]:
            lo = at - at % WIDTH
            out.append(("".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + WIDTH])))
            at //= WIDTH
        return out


def copy_path(node: str, path: list[tuple[str, str]]) -> list[str]:
    """A version's own nodes: ``node`` and its ancestors along a path; all other nodes are the old ones."""
    out = [node]
    for left, right in path:
        out.append(digest(left + out[-1] + right))
    return out


PATH = "array<struct<left: string, right: string>>"


def numbered(spark: SparkSession, rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``at``, the place in the group by ``order`` from 0, and ``n``, the size of the group.

    Rows are sorted once, over all tasks; the places of a task's rows follow from the counts of the
    tasks before it (a row for each task and group).
    """

    columns = rows.columns

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seq = TaskContext.get().partitionId(), object(), 0
        for frame in frames:
            places = []
            for value in frame.column(columns.index(group)).to_pylist():
                seq = seq + 1 if value == last else 0
                last = value
                places.append(seq)
            yield pa.RecordBatch.from_arrays([*frame.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], [*columns, "part", "seq"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    saved = written(spark, ranged.mapInArrow(count, f"{schema}, part int, seq long"), f"merkle-{label}")
    counts = saved.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    of_group = Window.partitionBy(group)
    before = F.sum("rows").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col(group).alias("_group"), F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("rows").over(of_group).alias("n"))
    met = saved.join(counts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
    return met.withColumn("at", F.col("_before") + F.col("seq")).select(*columns, "at", "n")


def blocks_of(nodes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(tree, block, n, nodes) from nodes (tree, at, n, digest, extra): at most ``SPAN`` nodes a row, in order."""
    one = F.struct("at", "digest", *extra)
    block = nodes.withColumn("block", F.expr(f"`at` div {SPAN}")).groupBy("tree", "block")
    return block.agg(F.first("n").alias("n"), F.array_sort(F.collect_list(one)).alias("nodes"))


def _tops(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        tops, sizes = [], frame.column("n").to_pylist()
        for n, nodes in zip(sizes, frame.column("nodes")):
            tops.append(Block([x["digest"] for x in nodes.as_py()], n).top)
        left = [-(-n // SPAN) for n in sizes]
        yield pa.RecordBatch.from_arrays([frame.column("tree"), frame.column("block"), pa.array(left, pa.int64()), pa.array(tops, pa.string())], ["tree", "at", "n", "digest"])


def climb(spark: SparkSession, blocks: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, lowest first, and (tree, digest) of what remains of every tree."""
    kind = blocks.schema["tree"].dataType.simpleString()
    rounds = [written(spark, blocks, f"merkle-{label}-0")]
    while True:
        tops = written(spark, rounds[-1].select("tree", "block", "n", "nodes").mapInArrow(_tops, f"tree {kind}, at long, n long, digest string"), f"merkle-{label}-top")
        if (tops.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds, tops.select("tree", "digest")
        rounds.append(written(spark, blocks_of(tops), f"merkle-{label}-{len(rounds)}"))


def _paths(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for row in range(frame.num_rows):
            own = [frame.column(c)[row].as_py() for c in ("n", "nodes", "path")]
            block = Block([x["digest"] for x in own[1]], own[0])
            above = own[2]
            for lo in range(0, len(own[1]), ROWS):
                part = own[1][lo : lo + ROWS]
                paths = [[{"left": a, "right": b} for a, b in block.path(x["at"] % SPAN)] + above for x in part]
                tree = frame.column("tree").take(pa.array([row] * len(part)))
                yield pa.RecordBatch.from_arrays([tree, pa.array([x["at"] for x in part], pa.int64()), pa.array(paths, _ARROW_PATH)], ["tree", "at", "path"])


_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def descend(spark: SparkSession, rounds: list[DataFrame], top: DataFrame, label: str) -> DataFrame:
    """(tree, block, path) for the blocks of the lowest round: the way from a block's top to the root.
    ``top`` is (tree, path), the way from what remains of each tree."""
    kind = top.schema["tree"].dataType.simpleString()
    paths = top.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for i in range(len(rounds) - 1, 0, -1):
        met = with_paths(rounds[i], paths).select("tree", "n", "nodes", "path")
        paths = written(spark, met.mapInArrow(_paths, f"tree {kind}, at long, path {PATH}"), f"merkle-{label}-path").withColumnRenamed("at", "block")
    return paths


def with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path that leads up from each."""
    up = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "path")
    return blocks.join(up, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")


def _versions(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the leaves of a block; every tampered leaf copies its ancestors, all others are shared."""
    for frame in frames:
        for row in range(frame.num_rows):
            n, nodes, above, subroot, root = (frame.column(c)[row].as_py() for c in ("n", "nodes", "path", "subroot", "root"))
            block = Block([x["digest"] for x in nodes], n)
            above = [(x["left"], x["right"]) for x in above]
            for lo in range(0, len(nodes), ROWS):
                part = nodes[lo : lo + ROWS]
                proofs, copies, folded = [], [], []
                for x in part:
                    path = block.path(x["at"] % SPAN) + above
                    proofs.append("".join([a + b for a, b in path]))
                    own = copy_path(x["digest"] if x["tampered"] is None else x["tampered"], path)
                    copies.append(None if x["tampered"] is None else own)
                    folded.append(own[-1])
                same = lambda value: pa.array([value] * len(part), pa.string())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["id"] for x in part], frame.column("nodes").type.value_type.field("id").type), frame.column("tree").take(pa.array([row] * len(part))), pa.array([x["at"] for x in part], pa.int64()), pa.array([x["digest"] for x in part], pa.string()), same(subroot), same(root), pa.array(proofs, pa.string()), pa.array(copies, pa.list_(pa.string())), pa.array(folded, pa.string())],
                    ["id", "source", "at", "leaf", "subroot", "root", "proof", "version", "folded"],
                )


def manifest(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """(id, source, at, leaf, subroot, root, proof, version, folded) for leaves (id, source, leaf, tampered).

    ``proof`` holds the siblings' digests from the leaf's level to the root. ``version`` is null
    without ``tampered``; else it holds the version's own nodes, from the tampered leaf to its root.
    ``folded`` is the root that the leaf, tampered or not, makes with the siblings.
    """
    rows = written(spark, pick(leaves, id="id", tree="source", digest="leaf", tampered="tampered"), "merkle-leaves")
    placed = numbered(spark, rows, "tree", ["id", "digest"], "placed")
    rounds, subroots = climb(spark, blocks_of(placed, ("id", "tampered")), "group")
    # the subroots are the leaves of one more tree
    tops = numbered(spark, subroots.select(F.lit(0).alias("all"), F.col("tree").alias("source"), "digest"), "all", ["source"], "subroots")
    tops = written(spark, tops.withColumnRenamed("all", "tree"), "merkle-tops")
    upper, roots = climb(spark, blocks_of(tops.drop("source")), "root")
    top = roots.first()
    ways = descend(spark, upper, roots.select("tree", F.array().cast(PATH).alias("path")), "root")
    ways = with_paths(upper[0], ways).select("tree", "n", "nodes", "path").mapInArrow(_paths, f"tree int, at long, path {PATH}")
    known = tops.join(ways.select("at", "path"), "at").select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "path")
    known = written(spark, known, "merkle-ways")
    lowest = with_paths(rounds[0], descend(spark, rounds, known.select("tree", "path"), "group"))
    lowest = lowest.join(known.select(F.col("tree").alias("_tree"), "subroot"), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    lowest = lowest.withColumn("root", F.lit(top["digest"] if top else None).cast("string"))
    id_kind, kind = (rows.schema[c].dataType.simpleString() for c in ("id", "tree"))
    return lowest.mapInArrow(_versions, f"id {id_kind}, source {kind}, at long, leaf string, subroot string, root string, proof string, version array<string>, folded string")


def documents_manifest(spark: SparkSession, docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest of documents by source; where ``tampered`` (over doc_id) holds, A-Z of the text are lower-cased."""
    rows = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    of = lambda text: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    lower = F.translate("text", UPPER, UPPER.lower())
    return manifest(spark, rows.select(F.col("doc_id").alias("id"), "source", of(F.col("text")).alias("leaf"), F.when(tampered, of(lower)).alias("tampered")))
