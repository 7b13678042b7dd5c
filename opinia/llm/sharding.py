"""Resharding by minimum-cost flow: bytes move from old shards to new capacities at least cost.

Old shards supply their bytes, new shards take up to their capacity, and moving a byte costs 1
unless it stays in the shard of the same number. The flow is solved on the shards' sizes alone.
The documents of an old shard are then ordered by a hash, and the flow cuts this order into
blocks, one for each new shard it sends to. Cuts fall between documents, so shards come out a
little off their capacity; therefore the smallest documents, a tenth of the bytes, are held
back and dealt by a second flow to what is still free.

A block's end is a value of the hash, and there are fewer of these than twice the number of shards in
each flow, so documents find their shard from a small table without being joined. Documents are
written once, into the folders of the shards whose content changes, balanced by size; the others
keep their files. A document's slot is its row in the shard's files, in their order.

Defined results: a null text has size 1 and no bytes; repeated rows are documents of their own,
that share a hash and so a block; null ids are hashed like others; a null old shard is the shard -1; old
shards outside the new ones are emptied; an empty table gives no rows; all columns are rewritten,
whatever their names, and those named ``shard`` or ``slot`` are replaced, after ``old`` has read them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, prefix_sums, unused

#: The share of the bytes that is held back for the second flow.
FILLER = 0.1


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: np.ndarray) -> np.ndarray:
    """Units from each source to each sink at least total cost, by successive shortest paths.

    The supplies must fit into the capacities. Each path exhausts a source or a sink, or takes
    back a flow that was sent before.
    """
    left, free = np.array(supply, np.int64), np.array(capacity, np.int64)
    if left.sum() > free.sum():
        raise ValueError("the capacities are too small")
    flow = np.zeros((len(left), len(free)), np.int64)
    while left.any():
        # Bellman-Ford over sources -> sinks, and back along what was sent.
        to_source = np.where(left > 0, 0.0, np.inf)
        to_sink = np.full(len(free), np.inf)
        back, via = np.full(len(left), -1), np.full(len(free), -1)
        while True:
            # Only what is strictly shorter replaces a step, or ties could close a circle.
            paths = to_source[:, None] + cost
            closer = paths.min(0) < to_sink - 1e-9
            via[closer] = paths.argmin(0)[closer]
            to_sink[closer] = paths.min(0)[closer]
            returns = np.where(flow > 0, to_sink[None, :] - cost, np.inf)
            shorter = returns.min(1) < to_source - 1e-9
            if not shorter.any():
                break
            back[shorter] = returns.argmin(1)[shorter]
            to_source[shorter] = returns.min(1)[shorter]
        sink = int(np.where(free > 0, to_sink, np.inf).argmin())
        path, amount, at = [], free[sink], sink
        while True:
            source = int(via[at])
            path.append((source, at, 1))
            if back[source] < 0:
                amount = min(amount, left[source])
                break
            at = int(back[source])
            path.append((source, at, -1))
            amount = min(amount, flow[source, at])
        for i, j, sign in path:
            flow[i, j] += sign * amount
        left[path[-1][0]] -= amount
        free[sink] -= amount
    return flow


def moving_cost(old: Sequence[int], new: int) -> np.ndarray:
    """1 for each byte that leaves the shard of its number."""
    cost = np.ones((len(old), new))
    for i, shard in enumerate(old):
        if 0 <= shard < new:
            cost[i, shard] = 0
    return cost


def _blocks(flow: np.ndarray, old: Sequence[int], least: int) -> list[tuple]:
    """(old shard, filler, new shard, first byte, number of blocks before) of each block; those
    that stay come first."""
    rows = []
    for i, shard in enumerate(old):
        order = sorted(np.flatnonzero(flow[i]), key=lambda j: (j != shard, j))
        start = 0
        for k, j in enumerate(order):
            rows.append((int(shard), int(least), int(j), int(start), k))
            start += int(flow[i, j])
    return rows


def assign(
    docs: DataFrame,
    old: Column,
    capacities: Sequence[float],
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    cost: np.ndarray | None = None,
) -> tuple[DataFrame, dict]:
    """``docs`` with ``shard``, and a report: the flow, bytes moved, the least that
    could be moved, and the shards that change. ``capacities`` are relative sizes; ``cost``
    (old by new) replaces the cost of moving a byte.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    old = F.coalesce(old.cast("int"), F.lit(-1))
    sized = scratch.store(docs.select(old.alias("_old"), key.alias("_key"), size.alias("_size")), "sizes")
    by_power = (
        sized.groupBy(F.floor(F.log2(F.col("_size"))).cast("int").alias("p")).agg(F.sum("_size").alias("n")).collect()
    )
    total, bound, held = sum(r["n"] for r in by_power), 1, 0
    for r in sorted(by_power):
        held += r["n"]
        if held > FILLER * total:
            break
        bound = 2 ** (r["p"] + 1)
    filler = (F.col("_size") < bound).cast("int").alias("_filler")
    sums = sized.groupBy("_old", filler).agg(F.sum("_size").alias("n")).collect()
    shards = sorted({r["_old"] for r in sums})
    supply = {(r["_old"], r["_filler"]): r["n"] for r in sums}
    whole = np.array(capacities, float) / sum(capacities)
    cost = moving_cost(shards, len(whole)) if cost is None else cost

    # Positions of documents in the order of their old shard; one range is never all of a shard.
    placed = scratch.store(
        prefix_sums(
            sized.select("_old", filler, "_key", "_size"), ["_old", "_filler", "_key", "_size"], {"_size": "_at"}, scratch
        ),
        "positions",
    )
    # Two rows for each old shard.
    begins = F.broadcast(placed.groupBy("_old", "_filler").agg(F.min("_at").alias("_begin")))
    middle = F.col("_at") - F.col("_begin") + F.col("_size") / 2
    schema = "_old int, _filler int, shard int, start long, before int"
    loads, cuts, flows = np.zeros(len(whole), np.int64), [], []
    for part in (0, 1):
        amounts = [supply.get((s, part), 0) for s in shards]
        # Of the first part, a share of each capacity; of the second, what is free then.
        goal = whole * sum(amounts) if part == 0 else np.maximum(whole * total - loads, 0)
        room = np.floor(goal * (sum(amounts) / max(goal.sum(), 1))).astype(np.int64)
        room[: max(0, sum(amounts) - int(room.sum()))] += 1
        short = sum(amounts) - int(room.sum())
        room += max(0, -(-short // len(room)))
        flow = min_cost_flow(amounts, room, cost)
        flows.append(flow)
        blocks = _blocks(flow, shards, part)
        if not blocks:
            continue
        bounds = F.broadcast(spark.createDataFrame(blocks, schema))
        near = placed.where(F.col("_filler") == part).join(begins, ["_old", "_filler"])
        starts = bounds.groupBy("_old", "_filler").agg(F.sort_array(F.collect_list("start")).alias("starts"))
        found = (
            near.join(F.broadcast(starts), ["_old", "_filler"])
            .withColumn("before", F.size(F.filter("starts", lambda x: x <= middle)) - 1)
            .groupBy("_old", "_filler", "before")
            .agg(F.min("_key").alias("_first"), F.sum("_size").alias("n"))
            .join(bounds, ["_old", "_filler", "before"])
            .collect()
        )
        for r in found:
            loads[r["shard"]] += r["n"]
            cuts.append((r["_old"], r["_filler"], r["_first"], r["shard"]))
    table = (
        spark.createDataFrame(cuts, "_old int, _filler int, first long, shard int")
        .groupBy("_old", "_filler")
        .agg(F.sort_array(F.collect_list(F.struct("first", "shard"))).alias("_cuts"))
    )
    marks, cuts_ = unused(docs, "_marks", "_cuts")
    mark = F.struct(old.alias("old"), (size < bound).cast("int").alias("filler"), key.alias("key"))
    marked = docs.withColumn(marks, mark).drop("shard", "slot")
    table = table.withColumnRenamed("_cuts", cuts_).select(F.struct("_old", "_filler").alias(f"{cuts_}of"), cuts_)
    whose = F.col(f"{cuts_}of")
    same = (F.col(f"{marks}.old") == whose["_old"]) & (F.col(f"{marks}.filler") == whose["_filler"])
    last = F.filter(cuts_, lambda x: x["first"] <= F.col(f"{marks}.key"))
    out = (
        marked.join(F.broadcast(table), same)
        .withColumn("shard", F.element_at(last, -1)["shard"])
        .drop(cuts_, f"{cuts_}of", marks)
    )
    flow = flows[0] + flows[1]
    stays = cost == 0
    old_sizes = np.array([supply.get((s, 0), 0) + supply.get((s, 1), 0) for s in shards])
    keeps = {s for i, s in enumerate(shards) if s < len(whole) and flow[i, s] == old_sizes[i] == flow[:, s].sum()}
    report = {
        "flow": flow,
        "moved": int(flow[~stays].sum()),
        "affected": sorted(set(range(len(whole))) - keeps),
        "loads": loads,
    }
    return out, report


def rewrite(assigned: DataFrame, affected: Sequence[int], folder: str, kept: dict[int, str] | None = None) -> DataFrame:
    """Writes the documents of the affected shards under ``folder``, a folder for each, and returns
    all documents with ``shard`` and ``slot``. ``kept`` has the folders of the other shards.
    """
    spark = assigned.sparkSession
    moving = assigned.where(F.col("shard").isin(*map(int, affected)))
    moving.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)
    schema = assigned.schema
    found = _numbered(spark.read.schema(schema).option("basePath", folder).parquet(folder))
    for shard, path in (kept or {}).items():
        plain = spark.read.parquet(path).withColumn("shard", F.lit(shard))
        found = found.unionByName(_numbered(plain))
    return found


def _numbered(files: DataFrame) -> DataFrame:
    """With ``slot``: the row's place in the files of its shard, in the order of their names."""
    file, row, before = unused(files, "_file", "_row", "_before")
    rows = files.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    so_far = Window.partitionBy("shard").orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", file)
        .agg(F.count("*").alias("n"))
        .select("shard", file, F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias(before))
    )
    return (
        rows.join(starts, ["shard", file])
        .withColumn("slot", (F.col(before) + F.col(row)).cast("long"))
        .drop(file, row, before)
    )


def reshard(
    docs: DataFrame, old: Column, capacities: Sequence[float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` in new shards 0 .. len(capacities) - 1, written to the shared folder: all columns,
    ``shard`` and ``slot``. ``old`` tells each document's present shard. A table has no files that could
    stay where they are, so all shards are written; :func:`reshard_files` writes the affected ones only."""
    scratch = Scratch(docs.sparkSession, "sharding")
    assigned, _ = assign(docs, old, capacities, scratch, id_col, text_col)
    return rewrite(assigned, range(len(capacities)), scratch.path("shards"))


def reshard_files(spark, folders: dict[int, str], capacities: Sequence[float], folder: str, **columns) -> DataFrame:
    """The same for shards that are folders of parquet files: only the shards whose content
    changes are written, under ``folder``; the others are read where they are."""
    parts = {shard: spark.read.parquet(path) for shard, path in folders.items()}
    (at,) = unused(next(iter(parts.values())), "_at")
    docs = None
    for shard, part in parts.items():
        part = part.withColumn(at, F.lit(shard))
        docs = part if docs is None else docs.unionByName(part)
    assigned, report = assign(docs, F.col(at), capacities, Scratch(spark, "sharding"), **columns)
    kept = {s: folders[s] for s in folders if s not in report["affected"] and s < len(capacities)}
    return rewrite(assigned.drop(at), report["affected"], folder, kept)
