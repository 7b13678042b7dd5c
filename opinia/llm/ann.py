"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a string of ``BITS`` bits: on which side of the median (of a bounded
sample) its random projections lie. A tree is the sorted array of these strings. A query descends
in every tree to the longest prefix it shares with others and then ascends in all trees at once,
a bit at a time, until the prefixes hold enough candidates, whose distances are computed
in full. How many are enough is found by measuring: for a bounded sample of queries the true
neighbours are found by brute force against all vectors, in blocks, and the smallest number
of candidates is taken whose recall on these reaches ``recall``.

The arrays lie in cells of about ``ROWS`` strings (a prefix, and beyond that a hash, where a
prefix holds more), each a group of its own; a query goes to the cells that its prefix covers.
A group returns the nearest few of a query, never all candidates.

Equal vectors are one entry with their smallest ids; no more of these can be among the results.

Defined results: vectors that are null, zero, of another length than most or hold null or
non-finite components take no part, also not as queries; a null id takes no part; candidates with the query's
own id are left out, and an id counts once; ties go to the smaller id; with fewer candidates than
``k`` all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, shuffle_partitions

BITS = 48
#: Entries of a cell, and queries that look at it in one group.
ROWS, QUERIES = 16_384, 2_048
#: Vectors that medians are taken from, and queries that the number of candidates is fitted on.
SAMPLE, PROBES = 4_096, 100


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``(cid, vec, ids, asked)``: distinct vectors, their ``k`` + 1 smallest ids, and whether a
    query is among them. Ids are cut in slices first, so frequent vectors meet in no one task."""
    cid = F.concat(F.hex(F.xxhash64("vec")), F.lit("-"), F.hex(F.hash("vec").cast("long")))
    slices = shuffle_partitions(rows.sparkSession)
    keyed = rows.select(cid.alias("cid"), "id", "asked").withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
    few = Window.partitionBy("cid", "_slice").orderBy("id")
    ids = (
        keyed.groupBy("cid", "_slice", "id")
        .agg(F.max("asked").alias("asked"))
        .withColumn("asked", F.max("asked").over(Window.partitionBy("cid", "_slice")))
        .withColumn("_n", F.row_number().over(few))
        .where(F.col("_n") <= k + 1)
        .groupBy("cid")
        .agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"), F.max("asked").alias("asked"))
    )
    vectors = rows.groupBy(cid.alias("cid")).agg(F.first("vec").alias("vec"))
    return vectors.join(ids, "cid")


class Forest:
    """Random projections and their medians."""

    def __init__(self, sample: np.ndarray, trees: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((trees, sample.shape[1], BITS)).astype(np.float32)
        self.medians = np.median(np.einsum("nd,tdb->tnb", sample, self.directions, optimize=True), axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The string of each vector in each tree, as a number."""
        powers = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        return np.stack(
            [(vectors @ d > m).astype(np.int64) @ powers for d, m in zip(self.directions, self.medians)], axis=1
        )


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings."""
    return BITS - np.frexp((a ^ b).astype(float))[1]


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(1))


def nearest(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` least distances, ties by id."""
    if len(found) > k:
        bound = np.partition(found, k - 1)[k - 1]
        near = np.flatnonzero(found <= bound)
    else:
        near = np.arange(len(found))
    return near[np.lexsort((ids[near], found[near]))][:k]


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as doubles."""
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()).astype(float).reshape(-1, dim)


def search(
    vectors: DataFrame,
    asked: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = 10,
    recall: float = 0.95,
    seed: int = 5,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row where ``asked``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "forest")
    rows = vectors.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), asked.cast("int").alias("asked")
    )
    kind = rows.schema["vec"].dataType.simpleString()
    result = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], result)
    dim = lengths["d"]
    rows = scratch.store(rows.where(F.size("vec") == dim), "rows")
    entries = scratch.store(distinct_vectors(rows, k), "distinct")
    n = entries.count()
    some = entries.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("vec").toArrow()
    forest = Forest(_matrix(some.column("vec"), dim), trees, seed)
    shared = spark.sparkContext.broadcast(forest)

    def hashed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            codes = shared.value.codes(_matrix(b.column("vec"), dim))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, trees), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names), flat], names=[*b.schema.names, "codes"])

    index = scratch.store(
        entries.mapInArrow(hashed, f"cid string, vec {kind}, ids array<bigint>, asked int, codes array<bigint>"), "index"
    )
    queries = index.where("asked = 1")
    probes = queries.orderBy(F.xxhash64("cid"), "cid").limit(PROBES).select("cid", "vec", "codes").toArrow()
    if not probes.num_rows:
        return spark.createDataFrame([], result)
    enough = fit_candidates(spark, index, probes, dim, k, recall)
    levels = min(BITS, max(0, int(np.ceil(np.log2(max(1.0, trees * n / max(enough, 1))))) + 2))
    cells = min(BITS, max(0, int(np.floor(np.log2(max(1.0, n / ROWS))))))

    # How many entries share each prefix of a query, in all trees together; then the longest that
    # has enough.
    prefix = lambda code, level: F.shiftright(code, BITS - level) if level else F.lit(0).cast("long")
    deepest = scratch.store(
        index.select(F.posexplode("codes").alias("tree", "code"))
        .groupBy("tree", prefix("code", levels).alias("node"))
        .agg(F.count("*").alias("n")),
        "nodes",
    )
    up = lambda node: F.explode(
        F.array(*[F.struct(F.lit(v).alias("level"), F.shiftright(node, levels - v).alias("node")) for v in range(levels + 1)])
    )
    counts = (
        deepest.select("tree", "n", up(F.col("node")).alias("e")).groupBy("tree", "e.level", "e.node").agg(F.sum("n").alias("n"))
    )
    asked_nodes = queries.select("cid", F.posexplode("codes").alias("tree", "code")).select(
        "cid", "tree", up(prefix("code", levels)).alias("e")
    ).select("cid", "tree", "e.level", "e.node")
    depth = (
        asked_nodes.join(counts, ["tree", "level", "node"])
        .groupBy("cid", "level")
        .agg(F.sum("n").alias("n"))
        .groupBy("cid")
        .agg(F.coalesce(F.max(F.when(F.col("n") >= enough, F.col("level"))), F.lit(0)).alias("level"))
    )
    # Cells, their chunks, and the blocks of queries that look at them.
    in_tree = index.select(
        "cid", "vec", F.element_at("ids", 1).alias("least"), F.posexplode("codes").alias("tree", "code")
    ).withColumn("cell", prefix("code", cells))
    span = F.greatest(F.lit(cells) - F.col("level"), F.lit(0))
    looking = (
        queries.join(depth, "cid")
        .select("cid", "vec", "level", F.posexplode("codes").alias("tree", "code"))
        .withColumn("_wide", span)
        .withColumn("_first", F.expr(f"shiftleft(shiftright(shiftright(code, {BITS - cells}), _wide), _wide)"))
        .withColumn("cell", F.explode(F.expr("sequence(_first, _first + shiftleft(1L, _wide) - 1)")))
        .drop("_wide", "_first")
    )
    sizes = (
        in_tree.groupBy("tree", "cell").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("chunks"))
        .join(looking.groupBy("tree", "cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks")), ["tree", "cell"])
    )
    sizes = scratch.store(sizes, "cells")
    part = lambda count: F.pmod(F.xxhash64("cid"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    held = in_tree.join(sizes, ["tree", "cell"]).withColumn("chunk", part("chunks")).withColumn("block", every("blocks"))
    asks = looking.join(sizes, ["tree", "cell"]).withColumn("block", part("blocks")).withColumn("chunk", every("chunks"))

    def look(left, right):
        import pandas as pd

        order = np.argsort(left["code"].to_numpy(), kind="stable")
        codes = left["code"].to_numpy()[order]
        cid, least = left["cid"].to_numpy()[order], left["least"].to_numpy()[order]
        entries = np.stack(left["vec"].to_numpy()).astype(float)[order] if len(left) else np.zeros((0, dim))
        out = []
        for q, vec, level, code in zip(right["query"], right["point"], right["bits"], right["string"]):
            low = (code >> (BITS - level)) << (BITS - level) if level else 0
            a, b = np.searchsorted(codes, [low, low + (1 << (BITS - level))])
            if a < b:
                found = distances(entries[a:b], np.asarray(vec, float))
                for at in nearest(found, least[a:b], k + 1):
                    out.append((q, cid[a + at], int(least[a + at]), float(found[at])))
        return pd.DataFrame(out, columns=["query", "cid", "least", "score"])

    keys = ["tree", "cell", "chunk", "block"]
    found = (
        held.select(*keys, "cid", "vec", "least", "code")
        .groupBy(*keys)
        .cogroup(
            asks.select(
                *[F.col(c).alias(f"_{c}") for c in keys],
                F.col("cid").alias("query"), F.col("vec").alias("point"), F.col("level").alias("bits"), F.col("code").alias("string"),
            ).groupBy(*[f"_{c}" for c in keys])
        )
        .applyInPandas(look, "query string, cid string, least long, score double")
    )
    best = Window.partitionBy("query").orderBy("score", "least")
    top = (
        found.groupBy("query", "cid", "least").agg(F.min("score").alias("score"))
        .withColumn("_n", F.row_number().over(best))
        .where(F.col("_n") <= k + 1)
        .join(index.select("cid", "ids"), "cid")
        .select("query", F.explode("ids").alias("vec_id"), "score")
        .withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")))
        .where(F.col("_n") <= k + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    )
    cid = F.concat(F.hex(F.xxhash64("vec")), F.lit("-"), F.hex(F.hash("vec").cast("long")))
    own = rows.where("asked = 1").select(F.col("id").alias("query_id"), cid.alias("query")).distinct()
    listed = own.join(top, "query").select(
        "query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near")
    )
    return listed.select("query_id", F.posexplode("near").alias("at", "hit")).select(
        F.col("query_id").cast("long"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").cast("long").alias("vec_id"), F.col("hit.score").alias("score"),
    )


def fit_candidates(spark, index: DataFrame, probes: pa.Table, dim: int, k: int, recall: float) -> int:
    """The number of candidates at which ascending can stop: the least whose recall on the probes
    reaches ``recall``, measured against the true neighbours among all entries."""
    names = probes.column("cid").to_pylist()
    asked = spark.sparkContext.broadcast(
        (names, _matrix(probes.column("vec"), dim), np.array(probes.column("codes").to_pylist(), np.int64))
    )

    def block(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, points, codes = asked.value
        tally = np.zeros((len(names), BITS + 1), np.int64)
        best: list[list[tuple[float, int]]] = [[] for _ in names]
        for b in found:
            vectors, own = _matrix(b.column("vec"), dim), np.array(b.column("codes").to_pylist(), np.int64)
            cids = np.array(b.column("cid").to_pylist(), object)
            for q in range(len(names)):
                shared = shared_bits(own, codes[q])
                tally[q] += np.bincount(shared.ravel(), minlength=BITS + 1)
                far = distances(vectors, points[q])
                far[cids == names[q]] = np.inf
                near = np.argpartition(far, min(k, len(far)) - 1)[:k]
                best[q] = sorted(best[q] + [(float(far[i]), int(shared[i].max())) for i in near if far[i] < np.inf])[:k]
        rows = [(q, -1.0, level, int(tally[q, level])) for q in range(len(names)) for level in range(BITS + 1) if tally[q, level]]
        rows += [(q, far, level, 0) for q in range(len(names)) for far, level in best[q]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["q", "far", "level", "n"])

    parts = index.select("cid", "vec", "codes").mapInArrow(block, "q long, far double, level long, n long")
    # Counts are added up, and only the nearest few of each probe are kept, before the driver sees them.
    few = Window.partitionBy("q").orderBy("far", "level")
    counts = parts.where("far < 0").groupBy("q", "level").agg(F.sum("n").alias("n")).collect()
    true = parts.where("far >= 0").withColumn("_r", F.row_number().over(few)).where(F.col("_r") <= k).select("q", "level").collect()
    holds = np.zeros((len(names), BITS + 1), np.int64)
    for r in counts:
        holds[r["q"], r["level"]] = r["n"]
    holds = holds[:, ::-1].cumsum(1)[:, ::-1]  # entries that share at least so many bits, in all trees
    depth: list[list[int]] = [[] for _ in names]
    for r in true:
        depth[r["q"]].append(r["level"])
    enough = 2 * k
    while True:
        level = np.array([np.flatnonzero(h >= min(enough, h[0])).max() for h in holds])
        hit = [np.mean([d >= at for d in ds]) for ds, at in zip(depth, level) if ds]
        if not hit or np.mean(hit) >= recall or not level.any():
            return int(enough)
        enough = int(enough * 1.2) + 1
