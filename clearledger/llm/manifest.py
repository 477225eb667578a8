"""Merkle manifest of a dataset, kept as blocks in van Emde Boas layout, with proofs for every row.

Each row is a leaf, the SHA-256 of five fields with their lengths. Per language the leaves ascend
by id, and while several nodes remain every ``FAN`` consecutive ones become the hash of their
digests (hexadecimal text). The roots of the languages, null first, then bytewise, make one more
tree, whose root stands for the dataset.

A tree is cut into aligned subtrees of ``LEVELS`` levels, the blocks. A block is one array of
digests in van Emde Boas order: the tree is split at half its height, the top part is stored first,
then every bottom part, each laid out in the same way. ``addresses`` gives the place of each node
by arithmetic alone, for construction (children of a node) and for proofs (a node and its siblings).
The roots of the blocks are the leaves of the next tier of blocks, and so on until one is left, so
no task ever holds more than a block, whatever a language's share of the rows.

Positions come from one range sort on (tree, id, leaf, row number) and counts per partition and
tree; texts are read once, for hashing, and only digests are shuffled.

Null fields are written ``-``; a null id sorts first and a null language is a tree of its own. Rows
that share an id are ordered by leaf; wholly equal rows are equal leaves, each with its own place.
Empty texts have length 0. Very long texts are hashed whole. Other columns are ignored, so they
cannot clash. An empty table has no root and no proofs.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearledger.llm.tables import written
from clearledger.llm.workers import tidy

FAN = 8
#: Levels of hashing in a block: at most FAN ** LEVELS leaves, 150 KB of digests.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32
PATH = "array<struct<before:string,after:string>>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Hexadecimal SHA-256 of the fields in the order of ``FIELDS``, each ``-`` if null, else its
    number of UTF-8 bytes, a colon and itself."""

    def part(c: Column) -> Column:
        said = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))

    return F.sha2(F.concat(*[part(fields[n]) for n in FIELDS]).cast("binary"), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- layout -----------------------------------------------------------------------------------


def tree_size(levels: int) -> int:
    """Nodes of a full tree with so many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: np.ndarray | int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes (depth from the root, index within the depth) of a full tree with so many
    levels of nodes lie in van Emde Boas order."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    width = FAN ** (depth - top)  # nodes of this depth in one bottom tree
    below = address(depth - top, index % width, levels - top)
    return tree_size(top) + index // width * tree_size(levels - top) + below


@functools.cache
def addresses(levels: int) -> list[np.ndarray]:
    """For each depth of a tree with so many levels of nodes, the addresses of its nodes."""
    return [address(d, np.arange(FAN**d), levels) for d in range(levels)]


def block_height(n: int, total: int, levels: int) -> int:
    """Levels of hashing in a block with n of the tree's total nodes of a tier: all of them, or,
    if it is the only block, as many as leave one node."""
    if total > FAN**levels:
        return levels
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


class Block:
    """Digests of an aligned subtree in van Emde Boas order, as hexadecimal text."""

    def __init__(self, height: int, n: int, nodes: list[str]):
        self.height, self.n, self.nodes = height, n, nodes

    @classmethod
    def built(cls, leaves: list[str], height: int) -> Block:
        at = addresses(height + 1)
        nodes = [""] * tree_size(height + 1)
        for i, leaf in enumerate(leaves):
            nodes[at[height][i]] = leaf
        n = len(leaves)
        for depth in range(height - 1, -1, -1):
            below, own, children = at[depth + 1], at[depth], n
            n = -(-n // FAN)
            for i in range(n):
                run = below[i * FAN : min((i + 1) * FAN, children)].tolist()
                nodes[own[i]] = digest("".join([nodes[a] for a in run]))
        return cls(height, len(leaves), nodes)

    def packed(self) -> bytes:
        return b"".join(bytes.fromhex(x) if x else bytes(DIGEST) for x in self.nodes)

    @classmethod
    def unpacked(cls, height: int, n: int, data: bytes) -> Block:
        said = data.hex()
        size = 2 * DIGEST
        return cls(height, n, [said[i : i + size] for i in range(0, len(said), size)])

    @property
    def root(self) -> str:
        return self.nodes[0]

    def runs(self) -> list[list[list[str]]]:
        """For each level from the leaves up, the runs of siblings."""
        at, n, out = addresses(self.height + 1), self.n, []
        for depth in range(self.height, 0, -1):
            own = at[depth][:n].tolist()
            out.append([[self.nodes[a] for a in own[i : i + FAN]] for i in range(0, n, FAN)])
            n = -(-n // FAN)
        return out


def path_in(runs: list[list[list[str]]], place: int) -> list[tuple[str, str]]:
    """What stands before and after a leaf, and each node above it, among its siblings."""
    out = []
    for level in runs:
        run, i = level[place // FAN], place % FAN
        out.append(("".join(run[:i]), "".join(run[i + 1 :])))
        place //= FAN
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def proof_digest(path: list[tuple[str, str]]) -> str:
    return digest("".join([x for level in path for x in level]))


# --- construction -----------------------------------------------------------------------------


def _positions(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """Rows (tree, ...) with ``pos``, their place within the tree, and ``total``, the tree's rows.

    The sorted rows are written with their partition and place; only counts per partition and
    tree, bounded by partitions and trees together, are summed up."""
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    until = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = counts.select(
        "tree",
        "part",
        (F.sum("n").over(until) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    return placed.join(known, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _grouped(rows: DataFrame, handle: Callable[[list[dict]], Iterator[tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Apply handle to the rows of each (tree, block), sorted by ``pos``; a block is bounded."""

    def made(batches):
        held: list[dict] = []
        out: list[tuple] = []

        def told():
            table = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow
            )
            out.clear()
            return table

        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["tree"], r["block"]) != (held[-1]["tree"], held[-1]["block"]):
                    out.extend(handle(held))
                    held = []
                    if len(out) >= 2_000:
                        yield told()
                held.append(r)
        if held:
            out.extend(handle(held))
        if out:
            yield told()

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(tidy(made), schema)


BLOCK_ROW = "tree string, block long, height int, n int, total long, root string, nodes binary"
_BLOCK_ROW = pa.schema(
    [("tree", pa.string()), ("block", pa.int64()), ("height", pa.int32()), ("n", pa.int32()),
     ("total", pa.int64()), ("root", pa.string()), ("nodes", pa.binary())]
)


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """The blocks of one tier from its nodes (tree, pos, total, digest)."""

    def build(held):
        total = held[0]["total"]
        block = Block.built([r["digest"] for r in held], block_height(len(held), total, levels))
        yield held[0]["tree"], held[0]["block"], block.height, block.n, total, block.root, block.packed()

    rows = nodes.select("tree", F.floor(F.col("pos") / FAN**levels).alias("block"), "pos", "total", "digest")
    return _grouped(rows, build, BLOCK_ROW, _BLOCK_ROW)


def _tiers(nodes: DataFrame, most: int, levels: int, purpose: str) -> list[DataFrame]:
    """Blocks of every tier, bottom first; ``most`` nodes are in the largest tree."""
    tiers, block = [], FAN**levels
    while True:
        tiers.append(written(_blocks(nodes, levels), f"{purpose}-blocks"))
        if most <= block:
            return tiers
        most = -(-most // block)
        nodes = tiers[-1].where(F.col("total") > block).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("total") / block).alias("total"), F.col("root").alias("digest")
        )


@dataclass(frozen=True)
class Manifest:
    """Leaves with their places, the blocks of the languages' trees and of the tree above them, and
    the root (None if there are no rows)."""

    leaves: DataFrame
    tiers: list[DataFrame]
    above: list[DataFrame]
    subroots: DataFrame
    root: str | None
    levels: int


def _roots(tiers: list[DataFrame], levels: int) -> DataFrame:
    """(tree, root): the roots of the blocks that are alone in their tree."""
    alone = [t.where(F.col("total") <= FAN**levels).select("tree", "root") for t in tiers]
    return functools.reduce(DataFrame.union, alone)


def build(docs: DataFrame, keep: dict[str, Column] | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of a table with the columns of ``FIELDS``, written to the shared folder.

    ``keep`` adds columns worked out from a row to its leaf; ``levels`` is the height of a block."""
    own = leaf_digest({n: F.col(n) for n in FIELDS})
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # null first, then bytewise
    rows = docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        own.alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        *[c.alias(n) for n, c in (keep or {}).items()],
    )
    leaves = written(_positions(written(rows, "leaves"), ["doc_id", "digest", "row"], "sorted"), "placed")
    most = leaves.agg(F.max("total")).first()[0]
    if most is None:
        return Manifest(leaves, [], [], leaves.select("tree", F.col("digest").alias("root")), None, levels)
    tiers = _tiers(leaves.select("tree", "pos", "total", "digest"), most, levels, "tree")
    subroots = written(_roots(tiers, levels), "subroots")
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest"))
    placed = written(_positions(named, ["of"], "languages"), "languages-placed")
    n_languages = placed.agg(F.max("total")).first()[0]
    above = _tiers(placed.select("tree", "pos", "total", "digest"), n_languages, levels, "above")
    root = _roots(above, levels).first()["root"]
    known = placed.select(F.col("of").alias("tree"), F.col("digest").alias("root"), "pos")
    return Manifest(leaves, tiers, above, known, root, levels)


# --- proofs -----------------------------------------------------------------------------------

_STEP = f"tree string, pos long, subroot string, path {PATH}"
_STEP_ROW = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("subroot", pa.string()), ("path", _PATH)])
PROOF = "doc_id long, row long, leaf string, subroot string, proof string, folded string"
_PROOF_ROW = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64())] + [(n, pa.string()) for n in ("leaf", "subroot", "proof", "folded")]
)


def _levels(path: list[dict] | None) -> list[tuple[str, str]]:
    return [(p["before"], p["after"]) for p in path or []]


def _opened(held: list[dict], levels: int) -> Iterator[tuple[dict, list[tuple[str, str]]]]:
    """The rows of a block with their paths to the top; the block's own row comes first."""
    head = held[0]
    runs, up = Block.unpacked(head["height"], head["n"], head["nodes"]).runs(), _levels(head["path"])
    for r in held[1:]:
        yield r, [*path_in(runs, r["pos"] % FAN**levels), *up]


def _stepped(rows: DataFrame, blocks: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """The paths (tree, pos, subroot, path) of nodes, from those of their blocks."""

    def step(held):
        for r, path in _opened(held, levels):
            yield r["tree"], r["pos"], held[0]["subroot"], [{"before": a, "after": b} for a, b in path]

    return written(_grouped(_with_blocks(rows, blocks, paths, levels), step, _STEP, _STEP_ROW), "paths")


def _with_blocks(rows: DataFrame, blocks: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Rows (tree, pos, ...) together with one row for each block (pos -1), which holds the block's
    digests and the path from its root up."""
    named = blocks.join(paths.withColumnRenamed("pos", "block"), ["tree", "block"])
    first = F.lit(-1).cast("long").alias("pos")
    heads = named.select("tree", "block", first, "height", "n", "nodes", "subroot", "path")
    placed = rows.withColumn("block", F.floor(F.col("pos") / FAN**levels))
    return heads.unionByName(placed, allowMissingColumns=True)


def _paths(tiers: list[DataFrame], roots: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, subroot, path): for each block of the lowest tier, the path from its root up.

    ``roots`` are the paths (tree, subroot, path) of the trees' roots. Going down, a tier's blocks
    give the blocks below them their paths; a tree with one block in a tier starts there."""
    paths = None
    for i in range(len(tiers) - 1, -1, -1):
        alone = tiers[i].where(F.col("total") <= FAN**levels).select("tree", F.lit(0).cast("long").alias("pos"))
        begun = alone.join(roots, "tree").select("tree", "pos", "subroot", "path")
        paths = begun if paths is None else paths.union(begun)
        if i:
            below = tiers[i - 1].where(F.col("total") > FAN**levels).select("tree", F.col("block").alias("pos"))
            paths = _stepped(below, tiers[i], paths, levels)
    return paths


def prove(manifest: Manifest, claim: Column) -> DataFrame:
    """(doc_id, row, leaf, subroot, root, proof, folded, verified), a row for each leaf.

    ``claim`` is a column of the leaves: the digest that is claimed to be the leaf. ``proof`` is the
    hash of all siblings from the leaf to the root, ``folded`` the root that the claim leads to with
    these siblings, ``verified`` whether it is the manifest's."""
    rows = manifest.leaves.select("tree", "pos", "doc_id", "row", F.col("digest").alias("leaf"), claim.alias("claim"))

    levels = manifest.levels

    def settle(held):
        for r, path in _opened(held, levels):
            folded = fold(r["claim"], path)
            yield r["doc_id"], r["row"], r["leaf"], held[0]["subroot"], proof_digest(path), folded

    if manifest.root is None:
        nothing = [F.lit(None).cast("string").alias(n) for n in ("subroot", "proof", "folded")]
        proofs = rows.select("doc_id", "row", "leaf", *nothing)
    else:
        start = F.lit("").alias("tree")
        # rows, not literals, which the planner would fold into a join without a key
        top = rows.sparkSession.createDataFrame([("", "", [])], f"tree string, subroot string, path {PATH}")
        languages = manifest.subroots.select(start, "pos")
        lifted = _stepped(languages, manifest.above[0], _paths(manifest.above, top, levels), levels)
        named = manifest.subroots.join(lifted.select("pos", "path"), "pos")
        paths = _paths(manifest.tiers, named.select("tree", F.col("root").alias("subroot"), "path"), levels)
        proofs = _grouped(_with_blocks(rows, manifest.tiers[0], paths, levels), settle, PROOF, _PROOF_ROW)
    told = proofs.withColumn("root", F.lit(manifest.root).cast("string"))
    return told.withColumn("verified", F.col("folded") == F.col("root"))
