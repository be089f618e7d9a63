"""Merkle trees over a table: a manifest with few stored levels, and proofs from it.

Each tree hashes its leaves two by two, level by level, until one node remains. A manifest
keeps only every ``every``-th level of the nodes. The levels between are not stored: a proof
needs them, and the nodes of an aligned subtree (2 ** ``every`` stored ones at most, whatever
the size of the tree) are enough to hash them anew. Proofs are therefore made subtree by
subtree, from the top stored level down; what was hashed anew is dropped with the row that held it.

The order of leaves comes from a range partitioning, so one tree may hold most of the rows.
A digest is the lowercase hex of SHA-256, and digests are hashed as that text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

#: Levels from one stored level to the next.
EVERY = 8
PATH = "array<struct<left: boolean, sibling: string>>"


def digest(*inputs: Column) -> Column:
    """SHA-256 of the inputs one after the other, as lowercase hex."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """A value so that no two rows look alike: '-' for null, else its length in bytes, ':' and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def tree_name(value: Column) -> Column:
    """Name of the tree of a group, never null; sorts as the group does, null first."""
    text = value.cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Add ``position`` (from 0, by ``order`` within ``tree``, nulls first) and ``depth`` of the tree.

    Equal rows take neighbouring positions. The rows are stored, since the bounds of ranges
    come from a pass of their own, and stored again, sorted by ranges; then
    a place is the row's place in its range, plus the rows of earlier ranges, less the place
    at which its tree begins. The table of ranges is bounded by the number of partitions.
    """
    by = ["tree", *order]
    read = stage(leaves, "unsorted").withColumn("_reader", F.spark_partition_id())
    ranged = read.repartitionByRange(*by, "_reader").drop("_reader").sortWithinPartitions(*by)
    rows = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "leaves")
    in_range = F.shiftright("_place", 33)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(in_range.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    in_order = rows.withColumn("_range", in_range).join(F.broadcast(ranges), "_range")
    line = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = in_order.withColumn("_line", line).drop("_range", "_before", "_place")
    trees = placed.groupBy(F.col("tree").alias("_tree")).agg(
        F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_leaves")
    )
    # Bits of the greatest position: the levels above the leaves.
    last = F.col("_leaves") - 1
    depth = F.when(last == 0, 0).otherwise(F.length(F.bin(last)))
    trees = stage(trees.select("_tree", "_first", depth.alias("depth")), "trees")
    return (
        placed.join(trees, F.col("tree") == F.col("_tree"))
        .withColumn("position", F.col("_line") - F.col("_first"))
        .drop("_line", "_tree", "_first")
    )


def _levels(nodes: Column, height: Column) -> Column:
    """Levels of a subtree: its digests, and those hashed from them, ``height`` levels up."""

    def above(level: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        return F.transform(
            pairs, lambda k: digest(F.get(level, 2 * k), F.coalesce(F.get(level, 2 * k + 1), F.lit("")))
        )

    return F.aggregate(
        _up_to(height),
        F.array(nodes),
        lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))),
    )


def _up_to(count: Column) -> Column:
    """0 to ``count`` less one."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _subtrees(nodes: DataFrame, base: int, every: int, *more: str) -> DataFrame:
    """Aligned subtrees of one stored level: ``subtree``, ``height``, ``nodes`` in order of position."""
    node = F.struct("position", "digest", *more)
    height = F.least(F.lit(every), F.col("depth") - base)
    return (
        nodes.groupBy("tree", "depth", F.shiftright("position", every).alias("subtree"))
        .agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        .withColumn("height", height)
    )


@dataclass
class Manifest:
    """Stored levels of all trees: ``stored[k]`` holds those of height ``every`` * k.

    Rows are (tree, depth, position, digest), in the first also the columns of the leaves.
    ``roots`` has (tree, depth, digest).
    """

    every: int
    stored: list[DataFrame]
    roots: DataFrame


def build(leaves: DataFrame, order: list[str], every: int = EVERY) -> Manifest:
    """Trees over ``leaves``: rows with ``tree`` (not null), ``digest`` and more columns.

    Leaves of a tree ascend by ``order``, nulls first; equal leaves may stand in any order,
    as all of them give the same tree. A tree of one leaf has that as its root. No leaf,
    no tree. Tables are written to the shared folder, one for every ``every`` levels.
    """
    nodes = stage(numbered(leaves, order), "level-0")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    stored = [nodes]
    for base in range(0, depth, every):
        below = stored[-1].filter(F.col("depth") > base)
        folded = _subtrees(below, base, every).select(
            "tree",
            "depth",
            F.col("subtree").alias("position"),
            F.get(F.element_at(_levels(F.col("nodes.digest"), F.col("height")), -1), F.lit(0)).alias("digest"),
        )
        stored.append(stage(folded, f"level-{base + every}"))
    done = [
        level.filter((F.col("depth") > (k - 1) * every) & (F.col("depth") <= k * every))
        for k, level in enumerate(stored)
    ]
    roots = reduce(lambda a, b: a.unionByName(b), [d.select("tree", "depth", "digest") for d in done])
    return Manifest(every, stored, roots)


def proofs(manifest: Manifest, keep: list[str] = ()) -> DataFrame:
    """(tree, position, digest, ``keep``, path): every leaf with the siblings up to its root.

    ``path`` has an entry a level: whether the sibling stands on the left, and the sibling,
    null where the node was alone. The leaf of a tree of one leaf has an empty path.
    """
    every, paths = manifest.every, None
    for k in reversed(range(len(manifest.stored))):
        nodes, more = manifest.stored[k], list(keep) if k == 0 else []
        if k:
            nodes = nodes.filter(F.col("depth") > k * every)
        subtrees = _subtrees(nodes, k * every, every, *more)
        if paths is None:
            subtrees = subtrees.withColumn("above", F.array().cast(PATH))
        else:
            top = paths.select(
                F.col("tree").alias("_tree"), F.col("position").alias("_subtree"), F.col("path").alias("above")
            )
            same = (F.col("tree") == F.col("_tree")) & (F.col("subtree") == F.col("_subtree"))
            subtrees = subtrees.join(top, same, "left").drop("_tree", "_subtree")
            subtrees = subtrees.withColumn("above", F.coalesce("above", F.array().cast(PATH)))
        paths = _proved(subtrees, every, more)
        if k:
            paths = stage(paths, f"paths-{k}")
    return paths


def _proved(subtrees: DataFrame, every: int, more: list[str]) -> DataFrame:
    """Nodes of the subtrees, each with its path; the levels between are hashed once a subtree."""
    within = F.lit((1 << every) - 1)

    def of_node(levels: Column, node: Column) -> Column:
        def step(level: Column) -> Column:
            # The node's place in the subtree, and that of its ancestor on this level.
            place = node["position"].bitwiseAND(within).cast("int")
            at = F.call_function("shiftright", place, level)
            left = at.bitwiseAND(F.lit(1)) == 1
            return F.struct(
                left.alias("left"), F.get(F.element_at(levels, level + 1), at.bitwiseXOR(F.lit(1))).alias("sibling")
            )

        local = F.transform(_up_to(F.col("height")), step)
        return F.struct(
            *[node[c].alias(c) for c in ("position", "digest", *more)],
            F.concat(local.cast(PATH), F.col("above")).alias("path"),
        )

    # A list of one holds the levels, so that they are made once and not for every node.
    once = F.array(_levels(F.col("nodes.digest"), F.col("height")))
    made = F.transform(once, lambda levels: F.transform("nodes", lambda node: of_node(levels, node)))
    return subtrees.select("tree", F.inline(F.get(made, F.lit(0))))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def up(node: Column, step: Column) -> Column:
        other = F.coalesce(step["sibling"], F.lit(""))
        return F.when(step["left"], digest(other, node)).otherwise(digest(node, other))

    return F.aggregate(path, leaf, up)


def siblings(path: Column) -> Column:
    """The siblings of a path one after the other, as text."""
    return F.array_join(path["sibling"], "")


def leaf_of(columns: list[Column]) -> Column:
    """Digest of a row: its columns as ``field`` gives them."""
    return digest(*[field(c) for c in columns])


def prove_rows(
    df: DataFrame, group: str, order: str, leaf: Column, keep: dict[str, Column], every: int = EVERY
) -> DataFrame:
    """Every row of ``df`` with its proof up to the root of the whole table.

    Rows of a ``group`` (null is a group) form a tree by ``order`` (null first; ties by digest).
    The roots of these trees, by group, null first, bytewise, are the leaves of a tree on top.
    Returns the columns of ``keep`` (any expressions over ``df``), leaf, subroot, root and
    ``path``, from the leaf to the root. Repeated rows each have a place, and a proof, of their
    own. Other columns of ``df`` are not carried. An empty table returns no row.
    """
    names = {f"_keep_{k}": name for k, name in enumerate(keep)}
    leaves = df.select(
        tree_name(F.col(f"`{group}`")).alias("tree"),
        F.col(f"`{order}`").alias("_order"),
        leaf.alias("digest"),
        *[keep[name].alias(inner) for inner, name in names.items()],
    )
    own = build(leaves, ["_order", "digest"], every)
    tops = own.roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    whole = build(tops, ["group"], every)
    root = whole.roots.select("tree", F.col("digest").alias("root"))  # one row
    top = proofs(whole, ["group"]).join(F.broadcast(root), "tree")
    top = stage(
        top.select("group", F.col("digest").alias("subroot"), F.col("path").alias("_top"), "root"), "subroots"
    )
    rows = proofs(own, list(names)).join(top, F.col("tree") == F.col("group"))
    return rows.select(
        *[F.col(inner).alias(name) for inner, name in names.items()],
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.concat("path", "_top").alias("path"),
    )
