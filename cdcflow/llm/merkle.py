"""A Merkle manifest of a table: a leaf digest for each row, trees of eight by part, and what a changed row does to the root.

Rows are put in order by ranges, so a part of any size is cut into blocks of 512 leaves (three levels of the tree), each of which
is one small group. A block's tree is built in its task and hands its top node to the next level of blocks, until each part has
one node; the parts' nodes are the leaves of one more tree, worked out the same way. Then paths go down again: each block
gets the siblings along the way from its top node to the root.

Blocks hold persistent trees. A changed leaf makes a version: its ancestors within the block are copied, all else is shared.
The version goes on through the copied upper nodes, whose siblings the block already has, so that no task sees the versions of
more than one block and nothing but top nodes is shuffled upwards.

Digests are SHA-256. A leaf covers its fields (``encoded``), a node the hexadecimal digests of its up to eight children.

Nulls and odd rows: null fields have a form of their own (``-``), so a null and an empty part differ; null parts and null ids come
first; rows of equal part and id follow one another by digest, equal rows in any order; an empty frame gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, same, saved

ARITY, BLOCK_LEVELS = 8, 3
BLOCK = ARITY**BLOCK_LEVELS
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """A persistent tree over up to 512 neighbouring leaves, whose first has a number divisible by 512."""

    def __init__(self, leaves: list[str], levels: int):
        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, leaf: int) -> list[tuple[str, str]]:
        """What stands to the left and right of the leaf and of its ancestors below the top."""
        out = []
        for nodes in self.levels[:-1]:
            first = leaf - leaf % ARITY
            out.append(("".join(nodes[first:leaf]), "".join(nodes[leaf + 1 : first + ARITY])))
            leaf //= ARITY
        return out

    def version(self, leaf: int, new: str) -> list[str]:
        """The nodes of a version in which one leaf differs, from it to the top; it shares all others with this tree."""
        copied = [new]
        for nodes in self.levels[:-1]:
            first = leaf - leaf % ARITY
            run = nodes[first : first + ARITY]
            run[leaf - first] = copied[-1]
            copied.append(digest("".join(run)))
            leaf //= ARITY
        return copied


def go_on(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a top node leads to, through copies of the upper nodes."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def encoded(*values: Column) -> Column:
    """Fields as one text: ``-`` for null, else the number of bytes, ``:`` and the value."""
    fields = []
    for value in values:
        text = value.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*fields)


def leaf_digest(*values: Column) -> Column:
    return F.sha2(encoded(*values).cast("binary"), 256)


def small_letters(text: Column) -> Column:
    """A-Z as a-z."""
    return F.translate(text, _CAPITALS, _SMALL)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``number``, from 0 in the given order (columns), which is spread over all tasks; equal rows in any order.

    The places within the tasks' ranges are written first; one row a task then says how many rows are before it.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = saved(placed, "placed").withColumn("range", F.shiftright("place", _ROW_BITS))
    ranges = placed.groupBy("range").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each task
    ranges = saved(ranges.select("range", F.coalesce(before, F.lit(0)).alias("before")), "ranges")
    number = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(ranges, "range").withColumn("number", number).drop("place", "range", "before")


def _levels(total: int) -> int:
    """Levels above the leaves of a tree over so many."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", BLOCK.bit_length() - 1))


def _block_of(table: pa.Table) -> tuple[Block, pa.Table]:
    table = table.sort_by("place")
    total = table["total"][0].as_py()
    return Block(table["node"].to_pylist(), min(BLOCK_LEVELS, _levels(total))), table


def _tops(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, place, total, node) to those that are up to three levels above; a tree of one node stays as it is."""

    def run(table: pa.Table) -> pa.Table:
        tree, table = _block_of(table)
        row = {"tree": table["tree"][0], "place": table["block"][0], "total": pa.scalar(-(-table["total"][0].as_py() // BLOCK)), "node": pa.scalar(tree.top)}
        return pa.table({name: pa.array([value.as_py()], value.type) for name, value in row.items()})

    return _blocks(nodes).groupBy("tree", "block").applyInArrow(run, "tree bigint, place bigint, total bigint, node string")


def _paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The path to the root of each node, from those of the nodes up to three levels above (tree, place, path)."""

    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        tree, table = _block_of(nodes)
        rest = above["path"][0].as_py()
        paths = [[{"left": a, "right": b} for a, b in tree.siblings(i)] + rest for i in range(table.num_rows)]
        path_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"tree": table["tree"], "place": table["place"], "path": pa.array(paths, path_type)})

    above = above.withColumnRenamed("place", "block")
    return _blocks(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(run, f"tree bigint, place bigint, path {_PATH}")


def trees(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Trees over leaves (tree, place, total, node): the nodes at every third level up to one node a tree, and these."""
    levels = [leaves]
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > 1:
        levels.append(saved(_tops(levels[-1]), "nodes"))
        most = -(-most // BLOCK)
    return levels[:-1], levels[-1]


def paths_down(levels: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the lowest level, from those of the trees' tops (tree, place, path)."""
    for nodes in reversed(levels):
        top_paths = saved(_paths(nodes, top_paths), "paths")
    return top_paths


def _proofs(leaves: DataFrame, above: DataFrame) -> DataFrame:
    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        tree, table = _block_of(leaves)
        rest = [(p["left"], p["right"]) for p in above["path"][0].as_py()]
        upper = "".join(left + right for left, right in rest)
        proofs, folded = [], []
        for i, changed in enumerate(table["changed"].to_pylist()):
            proofs.append(digest("".join(left + right for left, right in tree.siblings(i)) + upper))
            version = tree.version(i, tree.levels[0][i] if changed is None else changed)
            folded.append(go_on(version[-1], rest))
        n = table.num_rows
        return pa.table(
            {
                "id": table["id"],
                "leaf": table["node"],
                "subroot": pa.array([above["subroot"][0].as_py()] * n, pa.string()),
                "root": pa.array([above["root"][0].as_py()] * n, pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    id_type = leaves.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _blocks(leaves).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(run, schema)


def manifest(rows: DataFrame) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root of rows (id, part, node: the leaf's digest, changed: that after a change, or null)."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("int")  # so that ranges can cut through equal rows
    rows = saved(pick(rows, id="id", part="part", node="node", changed="changed").withColumn("spread", spread), "leaves")
    ordered = numbered(rows, "part", "id", "node", "spread").drop("spread")
    # A part's tree is known by the number of its first leaf.
    parts = ordered.groupBy("part").agg(F.min("number").alias("tree"), F.count("*").alias("total"))
    parts = saved(parts, "parts").withColumnRenamed("part", "of")
    leaves = ordered.join(parts, same(ordered.part, parts["of"])).select("tree", (F.col("number") - F.col("tree")).alias("place"), "total", "id", "node", "changed")
    leaves = saved(leaves, "places")
    levels, subroots = trees(leaves.select("tree", "place", "total", "node"))

    tops = saved(numbered(subroots.select("tree", F.col("node").alias("subroot")), "tree"), "tops")
    of_all = tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("number").alias("place"), F.lit(tops.count()).cast("bigint").alias("total"), F.col("subroot").alias("node"))
    upper, top = trees(of_all)
    root = top.first()  # one row, or none of an empty frame
    root_paths = paths_down(upper, top.select("tree", "place", F.array().cast(_PATH).alias("path"))).select(F.col("place").alias("number"), "path")
    known = tops.join(root_paths, "number").withColumn("root", F.lit(root["node"] if root else None).cast("string"))
    known = saved(known.select("tree", F.lit(0).cast("bigint").alias("place"), "path", "subroot", "root"), "known")

    # The lowest blocks' own paths are worked out together with their leaves' proofs.
    above = paths_down(levels[1:], known.select("tree", "place", "path")) if levels else known.select("tree", "place", "path")
    above = above.join(known.select("tree", "subroot", "root"), "tree").withColumnRenamed("place", "block")
    return _proofs(leaves, above)
