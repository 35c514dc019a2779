"""Merkle manifest of a table: one tree per group, one above the groups, and a version for every changed leaf.

Leaves are numbered per group in key order (ranges, written once; no window spans a group). ``2 ** LEVELS``
consecutive nodes make an aligned block, and a block is one task's work: its nodes become one node of the
next table, until every group has one (:func:`_climb`). On the way down every block gets the siblings of its
ancestors (:func:`_descend`), a row of some hundred bytes.

Trees are persistent (:class:`Tree`): nodes never change, and a changed leaf gets copies of its ancestors only,
which point to the untouched nodes beside them. A version is thus begun in the block of its leaf and goes on
through the upper blocks along the shared siblings that came down, without any gathering of versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.storage import materialize

LEVELS = 9

# Where the sibling of a node lies.
LEFT, RIGHT, NONE = "l", "r", "-"


def leaf_hash(values: Iterable[Column]) -> Column:
    """SHA-256 over the values as text, each with its length in bytes; a null is ``-``."""
    texts = [v.cast("string") for v in values]
    parts = (F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)
    return F.sha2(F.concat(*parts), 256)


def _hash(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """Nodes of one or more versions: a digest and the nodes below it, added once and never changed."""

    def __init__(self):
        self.digest: list[str] = []
        self.left: list[int] = []
        self.right: list[int] = []

    def leaf(self, digest: str) -> int:
        self.digest.append(digest)
        self.left.append(-1)
        self.right.append(-1)
        return len(self.digest) - 1

    def node(self, left: int, right: int = -1) -> int:
        """A node above two others, or above one that has no sibling."""
        at = self.leaf(_hash(self.digest[n] for n in (left, right) if n >= 0))
        self.left[at], self.right[at] = left, right
        return at

    def build(self, digests: list[str], levels: int) -> int:
        """Root of a block of digests after ``levels`` levels; one node must be left."""
        row = [self.leaf(d) for d in digests]
        for _ in range(levels):
            row = [self.node(*row[i:i + 2]) for i in range(0, len(row), 2)]
        if len(row) != 1:
            raise ValueError(f"{len(digests)} nodes make no block of {levels} levels")
        return row[0]

    def raise_along(self, root: int, siblings: list[str], path: str) -> list[int]:
        """Nodes from ``root`` up to the root of everything, along the siblings of its ancestors."""
        up, others = [root], iter(siblings)
        for side in path:
            if side == NONE:
                up.append(self.node(up[-1]))
            else:
                other = self.leaf(next(others))
                up.append(self.node(other, up[-1]) if side == LEFT else self.node(up[-1], other))
        return up

    def siblings(self, root: int, path: str) -> list[str]:
        """Digests beside the way from the leaf that ``path`` (from the leaf up) names to the root, from the leaf up."""
        found, node = [], root
        for side in reversed(path):
            if side == LEFT:
                found.append(self.digest[self.left[node]])
                node = self.right[node]
            else:
                if side == RIGHT:
                    found.append(self.digest[self.right[node]])
                node = self.left[node]
        return found[::-1]

    def replaced(self, root: int, path: str, digest: str) -> int:
        """Root of a new version with another leaf: copies of the leaf's ancestors, all else is shared."""
        way, node = [], root
        for side in reversed(path):
            way.append(node)
            node = self.right[node] if side == LEFT else self.left[node]
        new = self.leaf(digest)
        for side, node in zip(path, reversed(way)):
            new = self.node(self.left[node], new) if side == LEFT else self.node(new, self.right[node])
        return new


def block_paths(size: int, levels: int) -> list[str]:
    """For each of ``size`` nodes of a block, the sides of its siblings from itself up."""
    out = []
    for place in range(size):
        path, row, at = [], size, place
        for _ in range(levels):
            path.append(LEFT if at % 2 else RIGHT if at + 1 < row else NONE)
            at, row = at // 2, (row + 1) // 2
        out.append("".join(path))
    return out


def _height(nodes: int) -> int:
    """Levels above the nodes of a whole tree."""
    return (nodes - 1).bit_length()


def _hex(digests: pa.ChunkedArray) -> list[str | None]:
    return [None if d is None else d.hex() for d in digests.to_pylist()]


def _reduce(key, block):
    block = block.sort_by("pos")
    nodes = block["n"][0].as_py()
    tree = Tree()
    root = tree.build(_hex(block["digest"]), min(LEVELS, _height(nodes)))
    above = -(-nodes // (1 << LEVELS))
    return pa.table({"g": [key[0].as_py()], "pos": [key[1].as_py()], "n": [above],
                     "digest": pa.array([bytes.fromhex(tree.digest[root])], pa.binary())},
                    schema=pa.schema([("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))


NODES = "g string, pos long, n long, digest binary"
PATHS = "g string, pos long, siblings binary, path string, root binary"


def _block() -> Column:
    return F.shiftright("pos", LEVELS).alias("block")


def _climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """``nodes`` and the written tables of the blocks above, up to one node per group."""
    tables = [nodes]
    while (nodes.agg(F.max("n").alias("n")).first()["n"] or 1) > 1:
        blocks = nodes.select("g", "pos", "n", "digest").groupBy("g", _block())
        nodes = materialize(blocks.applyInArrow(_reduce, NODES), f"manifest_{name}")
        tables.append(nodes)
    return tables


def _split(siblings: bytes) -> list[str]:
    return [siblings[i:i + 32].hex() for i in range(0, len(siblings), 32)]


def _opened(block: pa.Table, above: pa.Table) -> tuple[Tree, list[int], int, list[str]]:
    """A block's tree up to the root of everything: its nodes upwards from the block's root, levels, paths of its nodes."""
    levels = min(LEVELS, _height(block["n"][0].as_py()))
    tree = Tree()
    root = tree.build(_hex(block["digest"]), levels)
    spine = tree.raise_along(root, _split(above["siblings"][0].as_py()), above["path"][0].as_py())
    upper = above["path"][0].as_py()
    return tree, spine, levels, [p + upper for p in block_paths(block.num_rows, levels)]


def _paths(key, block, above):
    block = block.sort_by("pos")
    tree, spine, _, paths = _opened(block, above)
    found = [bytes.fromhex("".join(tree.siblings(spine[-1], path))) for path in paths]
    return pa.table({"g": block["g"], "pos": block["pos"], "siblings": pa.array(found, pa.binary()), "path": pa.array(paths),
                     "root": pa.array([above["root"][0].as_py()] * block.num_rows, pa.binary())})


def _descend(tables: list[DataFrame], paths: DataFrame, name: str) -> DataFrame:
    """Paths of the nodes of ``tables[1]``, the blocks of the leaves, from those of the group's root."""
    for nodes in tables[-2:0:-1]:
        down = nodes.select("g", "pos", "n", "digest").groupBy("g", _block()).cogroup(paths.groupBy("g", "pos")).applyInArrow(_paths, PATHS)
        paths = materialize(down, f"manifest_{name}_paths")
    return paths


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (place inside ``g`` by ``order``) and ``n`` (rows of ``g``).

    Rows are sorted into files by ranges; a place is the rows of the group in the files before and those before
    it in its own. Rows equal in all of ``order`` may lie in several ranges: a row number of its own parts them.
    """
    staged = materialize(rows.withColumn("row", F.monotonically_increasing_id()), f"manifest_{name}_leaves")
    by = ["g", *order, "row"]
    ordered = materialize(
        staged.repartitionByRange(*by).sortWithinPartitions(*by).drop("row").withColumn("part", F.spark_partition_id()),
        f"manifest_{name}_ordered")
    listed = ordered.select("*", F.col("_metadata.row_index").alias("at"))
    parts = listed.groupBy("g", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("g")  # as many rows as the group has files
    starts = materialize(parts.select(
        "g", "part", "first",
        (F.sum("rows").over(whole.orderBy("part")) - F.col("rows")).alias("before"),
        F.sum("rows").over(whole).alias("n")), f"manifest_{name}_starts")
    return listed.join(starts, ["g", "part"]).select(
        "*", (F.col("before") + F.col("at") - F.col("first")).alias("pos")).drop("part", "at", "first", "before")


def _prove(key, block, above):
    block = block.sort_by("pos")
    tree, spine, levels, paths = _opened(block, above)
    stored = above["root"][0].as_py().hex()
    root = spine[-1]
    if tree.digest[root] != stored:
        raise ValueError(f"block {key} does not lead to the root: a node was lost or changed between passes")
    # The block's root stands `levels` above the leaves; its group's root as many as the whole group asks for.
    subroot = tree.digest[spine[_height(block["n"][0].as_py()) - levels]]
    changed = _hex(block["changed"])
    versions = [root if new is None else tree.replaced(root, path, new) for new, path in zip(changed, paths)]
    ends = [tree.digest[v] for v in versions]
    found = [bytes.fromhex("".join(tree.siblings(root, path))) for path in paths]
    size = block.num_rows
    return pa.table({
        "key": block["key"], "leaf": pa.array(_hex(block["digest"])), "subroot": pa.array([subroot] * size),
        "root": pa.array([stored] * size), "siblings": pa.array(found, pa.binary()), "path": pa.array(paths),
        "version_root": pa.array(ends), "verified": pa.array([e == stored for e in ends])})


def prove(rows: DataFrame, key: Column, group: Column, leaf: Column, changed: Column | None = None) -> DataFrame:
    """One row per row of ``rows``: ``key, leaf, subroot, root, siblings, path, version_root, verified``.

    ``leaf`` is a SHA-256 digest as hex text. Per group the leaves ascend by key (null first; equal keys by
    digest, then changed digest); two consecutive nodes (the last alone if their number is odd) become the digest of their hex texts,
    until one is left. These subroots, in bytewise order of the groups (null first), become the root likewise. ``siblings``
    are the 32-byte digests beside the way from the leaf to the root and ``path`` their sides (``l``, ``r``, ``-`` for
    none). Where ``changed`` is not null it is the leaf of a version of its own; ``version_root`` is that version's
    root (else the root) and ``verified`` tells whether it is the root.

    Null keys and groups take part as said, rows that repeat are leaves of their own, other columns do not
    matter, texts are hashed where they lie and not moved, and an empty table gives no rows.
    """
    new = F.lit(None).cast("binary") if changed is None else F.unhex(changed)
    # Null before all others, and never null itself: it is a join key.
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = _numbered(rows.select(
        key.cast("long").alias("key"), name.alias("g"), F.unhex(leaf).alias("digest"), new.alias("changed")),
        ["key", "digest", "changed"], "rows")
    lower = _climb(leaves, "rows")
    subroots = lower[-1].select(F.col("g").alias("name"), "digest")
    groups = _numbered(subroots.select(F.lit("").alias("g"), "name", "digest"), ["name"], "groups")
    upper = _climb(groups, "groups")
    root = upper[-1].select("g", "pos", F.lit(b"").alias("siblings"), F.lit("").alias("path"), F.col("digest").alias("root"))
    above = _descend([groups, *upper], root, "groups")  # down to the groups themselves
    named = groups.select("name", "pos").join(above.drop("g"), "pos").select(
        F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "siblings", "path", "root")
    down = _descend(lower, named, "rows")
    return leaves.groupBy("g", _block()).cogroup(down.groupBy("g", "pos")).applyInArrow(
        _prove, "key long, leaf string, subroot string, root string, siblings binary, path string, version_root string,"
        " verified boolean")
