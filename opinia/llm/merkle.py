"""A Merkle manifest of a table: leaves by row, subroots by group, one root, and proofs.

Every row is a leaf: the digest of its columns, each as ``-`` if null and else as its UTF-8
length, a colon and its text. The leaves of a group, in the order of their key, are the lowest
level of a tree; every two consecutive nodes, or the last one alone, become the digest of their
hex texts until one node is left, the subroot. The subroots, in the order of their groups, make
the last tree, whose top is the root.

A node of a level stands in the row of its first leaf. Its sibling therefore stands a fixed
number of rows away, ``2 ** level``, and one window with lead and lag columns of fixed offsets,
masked by the row's slot and the length of the run, gives every level its siblings and lets the
rows of first children hash the parents. Windows go over blocks of ``2 ** BITS`` consecutive slots
of a group, so a group that holds most rows is many small windows. The first rows of the
blocks are the lowest level of the next ``BITS`` levels, and so on; a block's siblings are looked
up by its leaves on the way down. Slots come from running counts over ranges, not from a window
over a group. The driver sees one number for each ``BITS`` levels.

Defined results: null columns count as ``-``; null groups are a group, the first; null keys come
first; rows of equal keys are ordered by their leaves, so that the order of equal rows, which are
leaves of their own, does not matter; an empty text is ``0:``; an empty table gives no rows;
columns that are not named do not count and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, prefix_sums

#: Levels that one window makes; blocks have ``2 ** BITS`` rows.
BITS = 8
#: A run of ``2 ** RUN_BITS`` leaves looks up its tree at once.
RUN_BITS = 10


def encoded(column: Column) -> Column:
    """A value as ``-`` if null, else its UTF-8 length, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def digest(*columns: Column) -> Column:
    """SHA-256 of the values in a row, as lower-case hex."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def _slots(nodes: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``nodes`` with their place ``slot`` in their tree, and its number of leaves, ``leaves``."""
    one = nodes.withColumn("one", F.lit(1).cast("long"))
    placed = scratch.store(prefix_sums(one, ["tree", *order], {"one": "before"}, scratch).drop("one"), "placed")
    placed = placed.withColumn("run", F.shiftright("before", RUN_BITS))
    runs = placed.groupBy("tree", "run").agg(F.min("before").alias("first"), F.count("*").alias("leaves"))
    trees = runs.groupBy("tree").agg(F.min("first").alias("first"), F.sum("leaves").alias("leaves"))
    # Leaves learn of their tree by its runs, so that a large tree is no hot key.
    known = runs.select("tree", "run").join(trees, "tree")
    return placed.join(known, ["tree", "run"]).select(
        "leaves", (F.col("before") - F.col("first")).alias("slot"), *nodes.columns
    )


def _block_levels(nodes: DataFrame) -> DataFrame:
    """``nodes (tree, slot, leaves, node, ...)`` with ``block``; with ``top``, the node that stands
    for the block ``BITS`` levels up, in the block's first row; and with ``path``, what every row's
    node is hashed with on the way there: an array of (before, after), '' where there is nothing.
    """
    rows = Window.partitionBy("tree", "block").orderBy("slot")
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = nodes.withColumns({"block": F.shiftright("slot", BITS), "top": F.col("node")})
    for level in range(BITS):
        step = 1 << level
        here = F.pmod("slot", F.lit(step)) == 0
        first_child = F.pmod("slot", F.lit(2 * step)) == 0
        # One node is left where a whole tree is below it.
        growing = F.col("leaves") > step
        after = F.when(first_child, F.coalesce(F.lead("top", step).over(rows), F.lit("")))
        before = F.when(~first_child, F.lag("top", step).over(rows))
        met = F.struct(F.coalesce(before, F.lit("")).alias("before"), F.coalesce(after, F.lit("")).alias("after"))
        df = df.withColumn("met", F.when(here, F.struct(growing.alias("growing"), met.alias("met"))))
        # What a node meets, all leaves below it meet.
        df = df.withColumn(f"met_{level}", F.last("met", True).over(so_far))
        parent = F.sha2(F.concat(F.col("top"), F.col("met.met.after")), 256)
        df = df.withColumn("top", F.when(first_child, F.when(growing, parent).otherwise(F.col("top"))))
    steps = F.array(*[F.when(F.col(f"met_{i}.growing"), F.col(f"met_{i}.met")) for i in range(BITS)])
    return df.withColumn("path", F.array_compact(steps)).drop("met", *[f"met_{i}" for i in range(BITS)])


def _climb(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """``nodes (tree, slot, leaves, node, ...)`` and above them, for every ``BITS`` levels, the nodes
    that stand for a block of those below; the last has one row for each tree, its top."""
    levels = [nodes]
    while True:
        heads = _block_levels(levels[-1]).where(F.pmod("slot", F.lit(1 << BITS)) == 0)
        above = heads.select(
            "tree",
            F.col("block").alias("slot"),
            F.shiftright(F.col("leaves") + ((1 << BITS) - 1), BITS).alias("leaves"),
            F.col("top").alias("node"),
        )
        levels.append(scratch.store(above, "heads"))
        if (levels[-1].agg(F.max("leaves").alias("n")).first()["n"] or 0) <= 1:
            return levels


def _descend(levels: list[DataFrame], tops: DataFrame, scratch: Scratch) -> DataFrame:
    """The lowest of ``levels`` with ``path``, all that its nodes meet on their way up, and the columns
    of ``tops (tree, path, ...)``, a row for each tree with what its top meets after that."""
    known = [c for c in tops.columns if c not in ("tree", "path")]
    up = tops.select("tree", F.lit(0).cast("long").alias("block"), *known, F.col("path").alias("rest"))
    for nodes in reversed(levels[1:]):
        found = _block_levels(nodes).drop("top").join(up, ["tree", "block"])
        ways = found.select("tree", F.col("slot").alias("block"), *known, F.concat("path", "rest").alias("rest"))
        up = scratch.store(ways, "ways")
    # A key of this join is a block, so it has few rows, whatever the size of a tree.
    found = _block_levels(levels[0]).drop("top").join(up, ["tree", "block"])
    return found.select(*levels[0].columns, *known, F.concat("path", "rest").alias("path"))


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its path give."""
    return F.aggregate(path, node, lambda h, m: F.sha2(F.concat(m["before"], h, m["after"]), 256))


def proof(path: Column) -> Column:
    """What a path meets, from the leaf to the root, each level from left to right."""
    return F.array_join(F.transform(path, lambda m: F.concat(m["before"], m["after"])), "")


def manifest(
    rows: DataFrame,
    columns: Sequence[str],
    key: str = "doc_id",
    group: str = "lang",
    found: dict[str, Column] | None = None,
) -> DataFrame:
    """``(key, group, leaf, found_leaf, subroot, root, path)``, a row for each row of ``rows``.

    ``columns`` are hashed in their order; ``path`` is what the leaf meets on its way to the root.
    ``found`` has columns as they are found when the manifest is checked, and ``found_leaf`` is the
    leaf with these; without any it is the leaf.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    own = {c: F.col(f"`{c}`") for c in columns}
    leaves = scratch.store(
        rows.select(
            F.col(key).alias("key"),
            F.col(group).alias("group"),
            # Texts that begin alike order the null group before all others.
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
            digest(*own.values()).alias("node"),
            digest(*(own | (found or {})).values()).alias("found_leaf"),
            # Equal rows are told apart, so that many of them are not one range.
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    levels = _climb(_slots(leaves, ["key", "node", "row"], scratch), scratch)
    subroots = levels.pop().select(F.lit("").alias("tree"), F.col("tree").alias("group_tree"), "node")
    joint = _climb(_slots(subroots, ["group_tree"], scratch), scratch)
    nowhere = F.array().cast("array<struct<before: string, after: string>>")
    root = joint.pop().select("tree", F.col("node").alias("root"), nowhere.alias("path"))
    tops = scratch.store(
        _descend(joint, root, scratch).select(
            F.col("group_tree").alias("tree"), F.col("node").alias("subroot"), "root", "path"
        ),
        "tops",
    )
    return _descend(levels, tops, scratch).select(
        "key", "group", F.col("node").alias("leaf"), "found_leaf", "subroot", "root", "path"
    )
