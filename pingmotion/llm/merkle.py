"""Merkle manifest of a dataset as a persistent tree: versions by path copying.

Each source is a tree: its rows are leaves in the order of doc_id, every three consecutive nodes
become one, up to the source's subroot; the subroots, in the order of sources, are the leaves of the tree above.
Nodes are never changed. A tampered leaf makes a new version of the tree that copies the leaf's
ancestors and shares every other node with the version before.

Scale. Texts stay where they are: one map pass hashes each row, and only doc_id, source and digests
are sorted, by ranges of (source, doc_id), so that a source with a third of all rows is cut into
many ranges. A row's place in its source follows from one number per range. Blocks of
``3 ** BLOCK_LEVELS`` consecutive nodes, aligned so that no run of three crosses a block, are built in
a task each; their roots are the nodes of the next tier, a few thousandths of the rows, and so on to
the root. Versions are made beside their leaves: the block's tree is copied along the path
in memory, and above the block the version goes on along the path of the block's root, whose
siblings are shared by all versions and are sent down once per block. So no task gathers the versions of
the upper tree, however many leaves were tampered with.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: fixed value: so many consecutive nodes become one
ARITY = 3
#: levels of a block: 2,187 leaves
BLOCK_LEVELS = 7


def digest(*parts: str) -> str:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return sha256("".join(parts).encode()).hexdigest()


class PersistentTree:
    """Versions of a tree over one pool of immutable nodes.

    A version is the number of its root. ``with_leaf`` makes a version in which one leaf differs: it
    adds that leaf and its ancestors to the pool and refers to all other nodes.
    """

    def __init__(self, leaves: list[str], levels: int | None = None):
        """``levels`` fixes the height; without it the tree ends where one node remains."""
        self.digests = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        nodes = list(range(len(leaves)))
        self.height = 0
        while len(nodes) > 1 if levels is None else self.height < levels:
            runs = [tuple(nodes[at : at + ARITY]) for at in range(0, len(nodes), ARITY)]
            nodes = [self._add(run) for run in runs]
            self.height += 1
        self.root = nodes[0]

    def _add(self, run: tuple[int, ...]) -> int:
        self.digests.append(digest(*(self.digests[c] for c in run)))
        self.children.append(run)
        return len(self.digests) - 1

    def _down(self, root: int, leaf: int) -> Iterator[tuple[int, int]]:
        """Node and the turn taken there, from the root to above the leaf."""
        for level in range(self.height - 1, -1, -1):
            turn = leaf // ARITY**level % ARITY
            yield root, turn
            root = self.children[root][turn]

    def with_leaf(self, root: int, leaf: int, value: str) -> int:
        way = list(self._down(root, leaf))
        self.digests.append(value)
        self.children.append(())
        node = len(self.digests) - 1
        for parent, turn in reversed(way):
            run = self.children[parent]
            node = self._add((*run[:turn], node, *run[turn + 1 :]))
        return node

    def siblings(self, root: int, leaf: int) -> list[tuple[str, str]]:
        """Per level, from the leaf up, the digests left and right of the path, joined."""
        found = []
        for parent, turn in self._down(root, leaf):
            run = [self.digests[c] for c in self.children[parent]]
            found.append(("".join(run[:turn]), "".join(run[turn + 1 :])))
        return found[::-1]


def folded(value: str, path: list[tuple[str, str]]) -> str:
    """The root over a node, from the siblings of each level."""
    for left, right in path:
        value = digest(left, value, right)
    return value


def leaf_digest(text: Column) -> Column:
    """The leaf of a row of documents, with ``text`` in the place of its text."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    fields = [part(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*fields, part(text)), 256)


def with_places(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``place``: the number of a row among the rows of its ``tree``, from 0, in the given order.

    Rows are sorted by ranges and counted in their range. A range begins inside one tree at
    most, so all that is missing is one number per range: how many rows of that tree stand before it.
    """
    ranged = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, tree, count = TaskContext.get().partitionId(), True, None, 0
        for batch in batches:
            trees = batch["tree"].to_pylist()
            place = np.zeros(len(trees), np.int64)
            heads = np.zeros(len(trees), bool)
            for row, name in enumerate(trees):
                if name != tree:
                    head, tree, count = tree is None, name, 0
                place[row], heads[row] = count, head
                count += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(trees), part)), pa.array(place), pa.array(heads)],
                [*batch.schema.names, "part", "place", "head"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    counted = stored(ranged.mapInArrow(run, f"{kinds}, part long, place long, head boolean"), "ranges")
    # names of trees may be long; a digest of each range's first and last one is enough
    name = F.sha2("tree", 256)
    ranges = counted.groupBy("part").agg(
        F.min(F.when(F.col("head"), name)).alias("first"),
        F.count_if("head").alias("n_first"),
        F.max(F.struct("tree", "place"))["place"].alias("last_place"),
        F.sha2(F.max("tree"), 256).alias("last"),
    )
    before, open_tree, run_length = [], None, 0
    for r in sorted(ranges.collect(), key=lambda r: r["part"]):  # as many rows as ranges
        carried = run_length if r["first"] == open_tree else 0
        before.append((r["part"], carried))
        run_length = r["last_place"] + 1 + (carried if r["first"] == r["last"] else 0)
        open_tree = r["last"]
    carry = nodes.sparkSession.createDataFrame(before, "part long, carried long")
    placed = counted.join(F.broadcast(carry), "part")
    at = F.col("place") + F.when(F.col("head"), F.col("carried")).otherwise(F.lit(0))
    return placed.select(*nodes.columns, at.alias("place"))


def _block() -> Column:
    return F.expr(f"place div {ARITY**BLOCK_LEVELS}L").alias("block")


def _tree_of(nodes: pa.Table) -> tuple[pa.Table, PersistentTree]:
    """A block's nodes in order and the tree over them. A first block that is not full is the whole
    tree and ends at one node; every other block has a run of blocks above it."""
    nodes = nodes.sort_by("place")
    digests = nodes["digest"].to_pylist()
    whole = nodes["place"][0].as_py() == 0 and len(digests) < ARITY**BLOCK_LEVELS
    return nodes, PersistentTree(digests, None if whole else BLOCK_LEVELS)


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Nodes ``tree, place, digest`` of every tier: the given ones, the roots of their blocks, and so
    on until each tree has one node."""
    tiers = [nodes]

    def run(key: tuple, block: pa.Table) -> pa.Table:
        _, tree = _tree_of(block)
        values = [[key[0].as_py()], [key[1].as_py()], [tree.digests[tree.root]]]
        return pa.table(dict(zip(("tree", "place", "digest"), values)))

    while True:
        blocks = tiers[-1].select("tree", "place", "digest", _block())
        roots = blocks.groupBy("tree", "block").applyInArrow(run, "tree string, place long, digest string")
        tiers.append(stored(roots, "blocks"))
        if not tiers[-1].where("place > 0").limit(1).count():
            return tiers


_PATH = "tree string, place long, subroot string, root string, left array<string>, right array<string>"


def _paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The way from every node of a tier to the root, from the ways of the nodes one tier above:
    siblings left and right per level."""

    def run(block: pa.Table, way: pa.Table) -> pa.Table:
        block, tree = _tree_of(block)
        up = way.to_pylist()[0]
        sides = [tree.siblings(tree.root, i) for i in range(len(block))]
        return pa.table(
            {
                "tree": block["tree"],
                "place": block["place"],
                "subroot": pa.array([up["subroot"]] * len(block), pa.string()),
                "root": pa.array([up["root"]] * len(block), pa.string()),
                "left": pa.array([[a for a, _ in s] + up["left"] for s in sides], pa.list_(pa.string())),
                "right": pa.array([[b for _, b in s] + up["right"] for s in sides], pa.list_(pa.string())),
            }
        )

    grouped = nodes.select("tree", "place", "digest", _block()).groupBy("tree", "block")
    return stored(grouped.cogroup(_by_block(above)).applyInArrow(run, _PATH), "ways")


def _by_block(ways: DataFrame):
    """Ways of block roots, to be met by the nodes of the blocks."""
    return ways.withColumnRenamed("place", "block").groupBy("tree", "block")


def _versions(leaves: DataFrame, ways: DataFrame) -> DataFrame:
    """The report of every leaf; one version of the block's tree for each leaf with ``tampered``."""

    def run(block: pa.Table, way: pa.Table) -> pa.Table:
        block, tree = _tree_of(block)
        up = way.to_pylist()[0]
        above = list(zip(up["left"], up["right"]))
        shared = "".join(a + b for a, b in above)
        unchanged = folded(tree.digests[tree.root], above)
        proofs, roots = [], []
        for i, value in enumerate(block["tampered"].to_pylist()):
            proofs.append(digest(*(a + b for a, b in tree.siblings(tree.root, i)), shared))
            if value is None:
                roots.append(unchanged)
            else:
                version = tree.with_leaf(tree.root, i, value)
                roots.append(folded(tree.digests[version], above))
        return pa.table(
            {
                "doc_id": block["doc_id"],
                "leaf": block["digest"],
                "subroot": pa.array([up["subroot"]] * len(block), pa.string()),
                "root": pa.array([up["root"]] * len(block), pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(roots, pa.string()),
                "verified": pa.array([r == up["root"] for r in roots], pa.bool_()),
            }
        )

    kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    grouped = leaves.select("tree", "place", "digest", "doc_id", "tampered", _block()).groupBy("tree", "block")
    return grouped.cogroup(_by_block(ways)).applyInArrow(run, kinds)


def tampered_text(text: Column, doc_id: Column) -> Column:
    """The text without line feeds where the CRC-32 of the decimal doc_id is even, else as it is.
    A null text or doc_id changes nothing."""
    chosen = F.crc32(doc_id.cast("string")) % 2 == 0
    return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of
    ``docs(doc_id, source, lang, n_chars, text, ...)``.

    ``tampered`` is the text as it is found now (default ``tampered_text``); the proof is checked
    with it. Rows without source are a tree of their own, before all others. In a source, rows without
    doc_id come first, and rows of one doc_id are ordered by their leaves, so the result does not depend
    on the order of the input; equal rows are leaves side by side. Null fields enter a leaf as ``-`` and
    differ from empty ones. A single row is its own root, with the hash of nothing as its proof. Other
    columns are not looked at. An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    now = tampered_text(text, F.col("doc_id")) if tampered is None else tampered
    leaves = docs.select(
        # null first, then by bytes
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(text).alias("digest"),
        F.when(~now.eqNullSafe(text), leaf_digest(now)).alias("tampered"),
    )
    leaves = stored(with_places(stored(leaves, "leaves"), ["doc_id", "digest"]), "placed")
    tiers = _tiers(leaves)
    subroots = tiers[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("source"))
    subroots = stored(with_places(subroots, ["source"]), "subroots")
    top = _tiers(subroots)
    nothing = F.array().cast("array<string>")
    ways = top[-1].select(
        "tree", "place", F.lit("").alias("subroot"), F.col("digest").alias("root"), nothing.alias("left"), nothing.alias("right")
    )
    for nodes in top[-2::-1]:
        ways = _paths(nodes, ways)
    # the way of a subroot is the way of the one node on its source's last tier
    ways = subroots.join(ways.drop("subroot", "tree"), "place").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "root", "left", "right"
    )
    for nodes in tiers[-2:0:-1]:
        ways = _paths(nodes, ways)
    return _versions(leaves, ways)
