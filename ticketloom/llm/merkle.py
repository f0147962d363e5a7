"""A Merkle manifest of a dataset: one ternary hash tree per group of rows, and one over the groups' roots.

A tree is stored as aligned blocks of a few levels, each an array in van Emde Boas
order (``veb``). The roots of a tree's blocks are the leaves of its next blocks, until
one is left; so a group of any size is built by many tasks, and a row's siblings are
read off one block a step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm import veb
from ticketloom.llm.shared import saved

BLOCK_HEIGHT = 7  # 2,187 leaves and 105 kB of digests
DIGEST = 32
STEP = "struct<left:string,right:string>"
PATH = f"array<{STEP}>"
BLOCK = "tree string, block bigint, n bigint, n_leaves bigint, root string, nodes binary"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_code(value: Column) -> Column:
    """``-`` for NULL, else the value's length in bytes, a colon and the value."""
    text = value.cast("string")
    code = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(code, F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_code(v) for v in values]).cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256)
    )


def ranked(leaves: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``leaves``, written once in order, with ``rank`` (from 0) and ``n`` of each tree.

    The rows are dealt to range partitions, so a tree that holds most of them lies in
    many; only how many of its rows each partition has is summed up.
    """
    sorted_rows = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    written = saved(sorted_rows.withColumn("place", F.monotonically_increasing_id()), name)
    placed = written.withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("here"), F.min("place").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col("tree").alias("run_tree"),
        F.col("part").alias("run_part"),
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(tree).alias("n"),
    )
    same = (F.col("part") == F.col("run_part")) & F.col("tree").eqNullSafe(F.col("run_tree"))
    return placed.join(offsets, same).select(*leaves.columns, (F.col("place") + F.col("shift")).alias("rank"), "n")


def tree_height(n: int) -> int:
    """How often ``n`` nodes are merged by threes until one is left."""
    height = 0
    while n > 1:
        n = -(-n // veb.ARITY)
        height += 1
    return height


def block_nodes(leaves: list[bytes], height: int) -> bytes:
    """The digests of a block in van Emde Boas order; nodes that do not exist are zeros."""
    store = bytearray(DIGEST * veb.size(height + 1))
    nodes = leaves
    for depth in range(height, -1, -1):
        if depth < height:
            nodes = [
                hashlib.sha256(b"".join(nodes[i : i + veb.ARITY]).hex().encode()).digest()
                for i in range(0, len(nodes), veb.ARITY)
            ]
        for address, node in zip(veb.addresses(height + 1, depth).tolist(), nodes):
            store[address * DIGEST : (address + 1) * DIGEST] = node
    return bytes(store)


def block_paths(store: bytes, n: int) -> list[list[dict[str, str]]]:
    """The siblings of each of the ``n`` leaves of a block, from the lowest level up.

    They are looked up once for each node and handed down, so leaves below a node share them.
    """
    height, nodes = 0, len(store) // DIGEST
    while veb.size(height + 1) < nodes:
        height += 1
    counts = [n]
    for _ in range(height):
        counts.append(-(-counts[-1] // veb.ARITY))
    paths: list[list[dict[str, str]]] = [[]]
    for depth in range(1, height + 1):
        places = veb.addresses(height + 1, depth)[: counts[height - depth]] * DIGEST
        row = [store[place : place + DIGEST].hex() for place in places.tolist()]
        steps = []
        for k in range(len(row)):
            first = k - k % veb.ARITY
            sides = {"left": "".join(row[first:k]), "right": "".join(row[k + 1 : first + veb.ARITY])}
            steps.append([sides, *paths[k // veb.ARITY]])
        paths = steps
    return paths


@dataclass
class Forest:
    """``levels[k]``: the blocks (BLOCK) whose leaves are ``k`` blocks above the trees' leaves."""

    levels: list[DataFrame]
    height: int

    def span(self, level: int) -> int:
        """Leaves of a tree below one block of a level."""
        return veb.ARITY ** (self.height * (level + 1))

    def roots(self) -> DataFrame:
        """``(tree, root)``: the root of a tree is that of its last block."""
        tops = [
            blocks.where((F.col("n") <= self.span(k)) & (F.col("block") == 0)).select("tree", "root")
            for k, blocks in enumerate(self.levels)
        ]
        found = tops[0]
        for top in tops[1:]:
            found = found.unionAll(top)
        return found


def build(leaves: DataFrame, name: str, height: int) -> Forest:
    """The blocks of all trees of ``leaves`` (tree, rank, n, leaf), written level by level."""
    fan = veb.ARITY**height
    fields = [c.split()[0] for c in BLOCK.split(", ")]

    def at_level(level: int):
        def block(table: pa.Table) -> pa.Table:
            table = table.sort_by("rank")
            n = table.column("n")[0].as_py()
            own_height = min(height, tree_height(n) - height * level)
            digests = [bytes.fromhex(d) for d in table.column("leaf").to_pylist()]
            store = block_nodes(digests, own_height)
            row = [
                table.column("tree")[0].as_py(),
                table.column("rank")[0].as_py() // fan,
                n,
                len(digests),
                store[:DIGEST].hex(),
                store,
            ]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], fields)

        return block

    forest = Forest([], height)
    largest = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    rows = leaves.select("tree", "rank", "n", "leaf")
    while True:
        level = len(forest.levels)
        keyed = rows.withColumn("block", F.floor(F.col("rank") / fan))
        blocks = saved(keyed.groupBy("tree", "block").applyInArrow(at_level(level), BLOCK), f"{name}-{level}")
        forest.levels.append(blocks)
        if largest <= forest.span(level):
            return forest
        rows = blocks.where(F.col("n") > forest.span(level)).select(
            "tree", F.col("block").alias("rank"), "n", F.col("root").alias("leaf")
        )


def _with_path(forest: Forest, level: int, above: DataFrame, upper: DataFrame | None) -> DataFrame:
    """A level's blocks with the siblings on the way from their root up."""
    blocks = forest.levels[level]
    last = F.col("n") <= forest.span(level)
    tops = above.select(F.col("tree").alias("top_tree"), F.col("path").alias("top_path"))
    found = blocks.where(last).join(tops, F.col("tree").eqNullSafe(F.col("top_tree")))
    found = found.select(*blocks.columns, F.col("top_path").alias("path"))
    if upper is None:
        return found
    way = upper.select(F.col("tree").alias("up_tree"), F.col("rank").alias("up_rank"), F.col("path").alias("up_path"))
    same = (F.col("block") == F.col("up_rank")) & F.col("tree").eqNullSafe(F.col("up_tree"))
    inner = blocks.where(~last).join(way, same).select(*blocks.columns, F.col("up_path").alias("path"))
    return found.unionAll(inner)


def paths(forest: Forest, leaves: DataFrame, above: DataFrame) -> DataFrame:
    """``leaves`` (tree, rank and any others) with ``path``: the siblings from the leaf up to
    its tree's root, then those that ``above`` (tree, path) gives for the root.

    Level by level, from the last blocks down, a block hands the way above it to its leaves.
    """
    fan = veb.ARITY**forest.height
    path_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def way(blocks: pa.Table) -> tuple[list, int]:
        row = blocks.slice(0, 1).to_pylist()[0]
        found = block_paths(row["nodes"], row["n_leaves"])
        return [own + row["path"] for own in found], row["block"] * fan

    def expand(blocks: pa.Table) -> pa.Table:
        found, first = way(blocks)
        tree = pa.array([blocks.column("tree")[0].as_py()] * len(found), pa.string())
        ranks = pa.array(range(first, first + len(found)), pa.int64())
        return pa.table([tree, ranks, pa.array(found, path_type)], ["tree", "rank", "path"])

    def of_leaves(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        found, first = way(blocks)
        own = [found[rank - first] for rank in rows.column("rank").to_pylist()]
        return rows.drop_columns(["block"]).append_column("path", pa.array(own, path_type))

    upper = None
    for level in range(len(forest.levels) - 1, 0, -1):
        known = _with_path(forest, level, above, upper)
        upper = known.groupBy("tree", "block").applyInArrow(expand, f"tree string, rank bigint, path {PATH}")
    blocks = _with_path(forest, 0, above, upper).groupBy("tree", "block")
    keyed = leaves.withColumn("block", F.floor(F.col("rank") / fan)).groupBy("tree", "block")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema)
    return keyed.cogroup(blocks).applyInArrow(of_leaves, f"{schema}, path {PATH}")


def proofs(rows: DataFrame, height: int = BLOCK_HEIGHT) -> DataFrame:
    """Builds the manifest of ``rows`` (tree, id, leaf and any others) and gives each row its proof.

    ``tree`` names the group (NULL is one), ``leaf`` is the hexadecimal digest of a row. A
    group's leaves are ordered by id (NULL first), ties by leaf; as long as several nodes
    remain, every three in succession become the digest of their concatenated digests, also
    if the last run is shorter. The groups' roots, ordered by name, make the root in the same
    way. Repeated rows are leaves of their own; no rows give no proofs.

    Returned are the rows with ``subroot``, ``root`` and ``path``, the siblings on the way
    to the root as left and right digests of each step: ``folded(leaf, path)`` is the
    root. A group lies in blocks of ``3 ** height`` leaves, whatever it holds.
    """
    carried = [c for c in rows.columns if c != "tree"]
    leaves = saved(ranked(rows, ["id", "leaf"], "merkle-order"), "merkle-leaves")
    forest = build(leaves, "merkle-blocks", height)
    members = forest.roots().select(
        F.lit(None).cast("string").alias("tree"), F.col("tree").alias("member"), F.col("root").alias("leaf")
    )
    tops = saved(ranked(members, ["member"], "merkle-top-order"), "merkle-top-leaves")
    top = build(tops, "merkle-top", height)
    root = top.roots().first()
    start = top.roots().select("tree", F.array().cast(PATH).alias("path"))
    ways = paths(top, tops.select("tree", "rank", "member", "leaf"), start)
    above = saved(ways.select(F.col("member").alias("tree"), F.col("leaf").alias("subroot"), "path"), "merkle-above")
    found = paths(forest, leaves.drop("n"), above)
    subroots = above.select(F.col("tree").alias("root_tree"), "subroot")
    return found.join(subroots, F.col("tree").eqNullSafe(F.col("root_tree"))).select(
        "tree", *carried, "subroot", F.lit(root["root"] if root else None).cast("string").alias("root"), "path"
    )


def document_proofs(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree_column: str = "source",
    id_column: str = "doc_id",
    claimed: Sequence[Column] | None = None,
    height: int = BLOCK_HEIGHT,
) -> DataFrame:
    """``(tree, id, leaf, subroot, root, path, folded_root, verified)`` of each row.

    A leaf is the digest of the row's ``fields``, each as its length and value, so that no
    two rows share one; NULL is a field of its own. ``claimed`` are the fields as they were
    found later (by default as they are): the root they give with the siblings of the
    manifest is ``folded_root``, and the row is verified if it is the root. Other columns
    take no part. For order, ties and repeated rows see ``proofs``.
    """
    rows = docs.select(
        F.col(tree_column).cast("string").alias("tree"),
        F.col(id_column).alias("id"),
        leaf_digest([F.col(f) for f in fields]).alias("leaf"),
        leaf_digest(claimed or [F.col(f) for f in fields]).alias("claimed"),
    )
    found = proofs(rows, height).withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop("claimed")
