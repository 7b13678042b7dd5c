"""The prefix trie of conversations by range minima over sorted longest common prefixes.

Conversations are sorted by their sequences of turns, shorter ones first, so that those which
start alike are neighbours. With the length that each shares with the one before it (LCP), the
members of a prefix are the widest interval around any of them in which no LCP is shorter than the
prefix. Each candidate prefix searches the left and the right end of that interval by itself, by
halving steps down a sparse table of range minima; a second table, over the ids, gives the
smallest member. No stack is kept, and no candidate waits for another.

The sorted conversations are ranges. A task has the tables of one range; intervals that leave it
end in the first range before or behind whose least LCP is shorter than the prefix, which the table
over the ranges' minima tells (a number for each range, on the driver and in all tasks), and there at a
place that this range lists for each depth at which it can be entered. Only prefixes of a range's
first or last conversation leave it, so these lists are as long as one conversation.

A subtree is an interval too, so its leaves and its saved tokens are differences of running sums
over positions. The ids that end at a node are the first of its interval, and are hashed
where they lie; if they run over ranges, their pieces are hashed one after the other, as a stream.

Texts are hashed where they are read and never move; a conversation is a row of 16 bytes a turn.
Turns are equal if the SHA-256 (its first half) of role and text is.

Defined results: rows with a null id belong to no conversation; null roles and texts are empty; null
turns come first, and of equal turns those of the smaller hash; repeated rows are turns of
their own; a conversation that is left without turns ends at the root; an empty table gives no
rows, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, bucket, prefix_sums, release, shuffle_partitions

NO_IDS = hashlib.sha256(b"").hexdigest()
#: No position, depth or id.
NONE = -1
FAR = np.iinfo(np.int64).max


def turns_of(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, turns)``: the hash and the code points of each turn, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("hash"),
        F.length(text).cast("long").alias("chars"),
    )
    own = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("t"))
    return own.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["hash"], t["chars"])).alias("turns")
    )


def rebuilt(conversations: DataFrame, group: int = 100, spread: int = 6, **columns) -> DataFrame:
    """``(conv_id, turns)`` with the first h turns of conversation ``c - c % group`` in place of the first
    h of c's own; h is crc32(c) modulo ``spread``."""
    own = turns_of(conversations, **columns)
    base = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, spread - 1)).alias("first"))
    h = bucket("conv_id", spread).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h}).join(base, "base", "left")
    none = F.slice("turns", 1, 0)
    return joined.select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("first", 1, F.col("h")), none),
            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))),
        ).alias("turns"),
    )


def sorted_ranges(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``(range, pos, conv_id, lcp, chars)``: the place of each conversation among all, the turns that it
    shares with the one before it (-1 for the first of all), and the code points of its turns."""
    paths = conversations.select("conv_id", F.col("turns.hash").alias("path"), F.col("turns.chars").alias("chars"))
    # Written before it is dealt into ranges, which reads it twice.
    paths = scratch.store(paths, "paths")
    parts = shuffle_partitions(paths.sparkSession)
    ranged = scratch.store(
        paths.repartitionByRange(parts, "path", "conv_id").withColumn("range", F.spark_partition_id()), "ranged"
    )
    in_order = Window.partitionBy(F.lit(0)).orderBy("range")  # a row for each range
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"), F.max("path").alias("last"))
    known = sizes.select(
        "range",
        (F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("start"),
        F.lag("last").over(in_order).alias("before"),
    )
    own = Window.partitionBy("range").orderBy("path", "conv_id")
    placed = ranged.select("*", F.row_number().over(own).alias("k"), F.lag("path").over(own).alias("previous"))
    placed = placed.join(known, "range").withColumn("previous", F.coalesce("previous", "before"))
    differs = F.array_position(F.zip_with("path", "previous", lambda a, b: ~a.eqNullSafe(b)), True)
    shared = F.when(differs > 0, differs - 1).otherwise(F.size("path"))
    return scratch.store(
        placed.select(
            "range",
            (F.col("start") + F.col("k") - 1).cast("long").alias("pos"),
            "conv_id",
            F.when(F.col("previous").isNull(), F.lit(NONE)).otherwise(shared).cast("long").alias("lcp"),
            "chars",
        ),
        "sorted",
    )


class SparseTable:
    """Minima of all runs of ``2 ** k`` values."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [np.asarray(values, np.int64)]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[: len(last) - half], last[half:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The least value of start .. stop - 1; FAR where there is none."""
        out = np.full(len(start), FAR)
        some = np.flatnonzero(stop > start)
        k = np.frexp(stop[some] - start[some])[1] - 1
        for level in np.unique(k):
            at = some[k == level]
            row = self.rows[level]
            out[at] = np.minimum(row[start[at]], row[stop[at] - (1 << int(level))])
        return out

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on whose value is below ``depth``, or the end."""
        at = start.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row = self.rows[level]
            fits = at + (1 << level) <= len(self.rows[0])
            go = fits & (row[np.where(fits, at, 0)] >= depth) if len(row) else fits
            at[go] += 1 << level
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``start`` whose value is below ``depth``, or -1."""
        at = start.copy()
        for level in range(len(self.rows) - 1, -1, -1):
            row = self.rows[level]
            first = at - (1 << level) + 1
            fits = first >= 0
            go = fits & (row[np.where(fits, first, 0)] >= depth) if len(row) else fits
            at[go] -= 1 << level
        return at


class Range:
    """The conversations of one range in order, and the tables over them."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by("pos").combine_chunks()
        self.name = table["range"][0].as_py()
        self.ids, self.lcp = table["conv_id"].to_numpy(), table["lcp"].to_numpy()
        self.start = int(table["pos"][0].as_py())
        chars = table["chars"].chunk(0)
        self.depth = chars.value_lengths().to_numpy().astype(np.int64)
        self.chars = chars.flatten().to_numpy()
        self.lcps, self.least = SparseTable(self.lcp), SparseTable(self.ids)

    def __len__(self) -> int:
        return len(self.ids)


def _rows(schema: pa.Schema, *columns) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


#: Where intervals of each depth that enter a range end, and the least id up to there. They are named by
#: the side to which they left another range.
DOORS = pa.schema([("range", pa.int32()), ("side", pa.string()), ("depth", pa.int64()), ("at", pa.int64()), ("least", pa.int64())])
NODES = pa.schema(
    [("left", pa.int64()), ("depth", pa.int64()), ("right", pa.int64()), ("conv_id", pa.int64()), ("above", pa.int64()),
     ("parent_conv_id", pa.int64()), ("chars", pa.int64()), ("ends", pa.string()), ("range", pa.int32()), ("piece", pa.string())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def doors(table: pa.Table) -> pa.Table:
    """Of one range: from the left, at which position an interval of each depth ends; from the right,
    at which it begins (null: at none, it runs through)."""
    here, n = Range(table), table.num_rows
    out = []
    for side, top in (("right", max(0, int(here.lcp[0]))), ("left", int(here.depth[-1]))):
        depth = np.arange(1, top + 1)
        if side == "right":
            at = here.lcps.right(np.zeros(top, np.int64), depth)
            least, through = here.least.least(np.zeros(top, np.int64), at), at == n
        else:
            at = here.lcps.left(np.full(top, n - 1), depth)
            least, through = here.least.least(np.maximum(at, 0), np.full(top, n)), at < 0
        at = pa.array(np.where(through, 0, at + here.start), pa.int64(), mask=through)
        out.append(_rows(DOORS, [here.name] * top, [side] * top, depth, at, least))
    release()
    return pa.concat_tables(out)


def _leaving(ranges: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the depths at which intervals leave a range (``range, side, depth``): the range in which they
    end (null: the end of all) and where it begins, and the least id of the ranges between."""
    names = np.array([r[0] for r in ranges])
    minima, ids = SparseTable(np.array([r[1] for r in ranges])), SparseTable(np.array([r[2] for r in ranges]))
    starts = np.append(np.cumsum([0] + [r[4] for r in ranges]), 0)
    for b in batches:
        own = np.searchsorted(names, b.column("range").to_numpy())
        depth = b.column("depth").to_numpy()
        right = np.array([s == "right" for s in b.column("side").to_pylist()], bool)
        to = np.where(right, minima.right(own + 1, depth), minima.left(own - 1, depth))
        least = ids.least(np.where(right, own + 1, to + 1), np.where(right, to, own))
        outside = (to < 0) | (to == len(names))
        target = pa.array(np.where(outside, 0, names[np.clip(to, 0, len(names) - 1)]), pa.int32(), mask=outside)
        yield pa.RecordBatch.from_arrays(
            [b.column("range"), b.column("side"), b.column("depth"), target, pa.array(starts[to]), pa.array(least, pa.int64())],
            names=["range", "side", "depth", "target", "start", "between"],
        )


def ways(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """The :data:`DOORS` by which intervals that leave a range end (``range`` is the one they leave); the
    number of conversations and the least id."""
    entered = scratch.store(rows.groupBy("range").applyInArrow(doors, _ddl(DOORS)), "doors")
    # Four numbers for each range.
    sums = rows.groupBy("range").agg(
        F.min("lcp").alias("lcp"), F.min("conv_id").alias("id"), F.count("*").alias("n"), F.min_by("lcp", "pos").alias("first")
    )
    found = sorted((r["range"], r["lcp"], r["id"], r["first"], r["n"]) for r in sums.collect())
    # An interval leaves a range to the left as deep as its first LCP, to the right as deep as the next one's.
    edges = [(r[0], "left", max(0, r[3])) for r in found]
    edges += [(a[0], "right", max(0, b[3])) for a, b in zip(found, found[1:])]
    spark = rows.sparkSession
    leaving = (
        spark.createDataFrame(edges, "range int, side string, top long")
        .where("top > 0")
        .select("range", "side", F.explode(F.sequence(F.lit(1).cast("long"), "top")).alias("depth"))
        .mapInArrow(lambda b: _leaving(found, b), "range int, side string, depth long, target int, start long, between long")
    )
    total, least = sum(r[4] for r in found), min((r[2] for r in found), default=0)
    inside = entered.select(F.col("range").alias("target"), "side", "depth", "at", "least")
    met = leaving.join(inside, ["target", "side", "depth"], "left")
    # No door is needed where an interval ends between two ranges, or at the end of all, which is where
    # the range after the last would begin. To the left there always is one, as the first LCP is -1.
    out = met.select(
        "range", "side", "depth", F.coalesce("at", "start").alias("at"),
        F.least("between", F.coalesce("least", F.lit(int(FAR)))).alias("least"),
    )
    return scratch.store(out, "ways"), total, least


def _hash(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def intervals(table: pa.Table, leaving: pa.Table) -> pa.Table:
    """The nodes whose interval begins in a range, with their parents; and, as rows without a depth, the
    pieces of runs of equal conversations that go over the range's end."""
    if not table.num_rows:
        return NODES.empty_table()
    here, n = Range(table), table.num_rows
    out = {}
    for side in ("left", "right"):
        some = leaving.filter(pc.equal(leaving["side"], side)).sort_by("depth")
        # By depth from 1: a range is left at all depths up to some.
        out[side] = [np.concatenate(([NONE], some[c].to_numpy())) for c in ("at", "least")]

    def extent(at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left end, right end and least id of the prefixes of some conversations."""
        left, right = here.lcps.left(at, depth), here.lcps.right(at + 1, depth)
        least = here.least.least(np.maximum(left, 0), right)
        first, last = left + here.start, right + here.start
        for edge, (to, ids), end in ((left < 0, out["left"], first), (right == n, out["right"], last)):
            # Depths at which the range is not left end with it.
            go = edge & (depth < len(to))
            end[go] = to[depth[go]]
            least[go] = np.minimum(least[go], ids[depth[go]])
        return first, last, least

    owner = np.repeat(np.arange(n), here.depth)
    starts = np.cumsum(here.depth) - here.depth
    depth = np.arange(len(owner)) - np.repeat(starts, here.depth) + 1
    left, right, least = extent(owner, depth)
    # A prefix is a node once: where its interval begins.
    heads = np.flatnonzero(left == owner + here.start)
    up = heads - 1
    of_root = depth[heads] == 1
    above = np.where(of_root, 0, left[up])
    parent = np.where(of_root, NONE, least[up])
    full = depth[heads] == here.depth[owner[heads]]

    # Runs of equal conversations; one that the next range may go on with is not hashed here.
    same = (here.lcp == here.depth) & np.concatenate(([True], here.depth[1:] == here.depth[:-1]))
    same[0] &= here.start > 0
    firsts = np.flatnonzero(~same)
    stops = np.append(firsts[1:], n) if len(firsts) else firsts
    goes_on = len(out["right"][0]) - 1
    ends: list[str | None] = [NO_IDS] * len(heads)
    run_of = {int(a): int(b) for a, b in zip(firsts, stops)}
    for k in np.flatnonzero(full):
        a = int(owner[heads[k]])
        open_ = run_of[a] == n and goes_on >= here.depth[a]
        ends[k] = None if open_ else _hash(here.ids[a : run_of[a]])
    nodes = _rows(
        NODES, left[heads], depth[heads], right[heads], least[heads], above, parent, here.chars[heads], ends,
        [here.name] * len(heads), [None] * len(heads),
    )

    # Pieces: of the run that comes from the range before, of that without turns, of the one that goes on.
    pieces = []
    head = int(firsts[0]) if len(firsts) else n
    if head:
        whose = int(extent(np.zeros(1, np.int64), here.depth[:1])[0][0]) if here.depth[0] else 0
        pieces.append((whose, int(here.depth[0]), 0, head))
    for a in firsts[[0, -1] if len(firsts) > 1 else slice(None)].tolist():
        if here.depth[a] == 0 or (run_of[a] == n and goes_on >= here.depth[a]):
            pieces.append((a + here.start, int(here.depth[a]), a, run_of[a]))
    texts = [",".join(map(str, here.ids[a:b].tolist())) for _, _, a, b in pieces]
    blank = [None] * len(pieces)
    extra = _rows(
        NODES, [p[0] for p in pieces], blank, blank, blank, blank, blank, [p[1] for p in pieces], blank,
        [here.name] * len(pieces), texts,
    )
    release()
    return pa.concat_tables([nodes, extra])


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(left, depth, ends)``: the hash of each run's pieces, which come in order."""
    now, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([state.hexdigest()])],
            names=["left", "depth", "ends"],
        )

    for b in batches:
        for left, depth, piece in zip(*(b.column(c).to_pylist() for c in ("left", "depth", "piece"))):
            if (left, depth) != now:
                if now is not None:
                    yield done()
                now, state = (left, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
    if now is not None:
        yield done()


def nodes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``,
    a row for each distinct sequence of first turns of ``conversations (conv_id, turns)``.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    rows = sorted_ranges(conversations, scratch)
    leaving, total, least = ways(rows, scratch)
    found = scratch.store(
        rows.groupBy("range").cogroup(leaving.groupBy("range")).applyInArrow(intervals, _ddl(NODES)), "intervals"
    )
    root = spark.createDataFrame([(0, 0, total, least, 0)] if total else [], "left long, depth long, right long, conv_id long, chars long")
    below = found.where("depth IS NOT NULL").select(
        "left", "depth", "right", "conv_id", "chars", "ends", "above",
        F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
    )
    every = root.unionByName(below, allowMissingColumns=True)

    children = below.groupBy(F.col("above").alias("left"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    pieces = found.where("piece IS NOT NULL").select("left", F.col("chars").alias("depth"), "range", "piece")
    in_order = pieces.repartition("left", "depth").sortWithinPartitions("left", "depth", "range")
    ends = in_order.mapInArrow(streamed, "left long, depth long, ends string").withColumnRenamed("ends", "over_ranges")
    known = scratch.store(
        every.join(children, ["left", "depth"], "left")
        .join(ends, ["left", "depth"], "left")
        .withColumns(
            {
                "n_convs": F.col("right") - F.col("left"),
                "n_children": F.coalesce("n_children", F.lit(0)),
                "ends": F.coalesce("over_ranges", "ends", F.lit(NO_IDS)),
            }
        )
        .withColumns(
            {
                "saved": (F.col("n_convs") - 1) * F.col("chars"),
                "leaf": (F.col("n_children") == 0).cast("long"),
            }
        )
        .drop("over_ranges", "above", "chars"),
        "nodes",
    )
    # What lies before each position at which nodes begin.
    at = known.groupBy(F.col("left").alias("pos")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    sums = scratch.store(
        prefix_sums(at, ["pos"], {"saved": "saved_before", "leaf": "leaves_before"}, scratch).drop("saved", "leaf"), "sums"
    )
    totals = known.agg(F.coalesce(F.sum("saved"), F.lit(0)).alias("s"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("l")).first()
    begin = sums.select(F.col("pos").alias("left"), F.col("saved_before").alias("s0"), F.col("leaves_before").alias("l0"))
    end = sums.select(F.col("pos").alias("right"), F.col("saved_before").alias("s1"), F.col("leaves_before").alias("l1"))
    # Nodes that begin at the same place lie on one path; those above are no part of the subtree.
    higher = Window.partitionBy("left").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    joined = known.withColumn("over", F.coalesce(F.sum("saved").over(higher), F.lit(0))).join(begin, "left")
    joined = joined.join(end, "right", "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.coalesce("l1", F.lit(totals["l"])) - F.col("l0")).alias("n_leaves"),
        (F.coalesce("s1", F.lit(totals["s"])) - F.col("s0") - F.col("over")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
