"""Exact top-k inner products by a three-phase uniform threshold.

The components of the vectors are cut into ``lists``, and a score is the sum of one partial score
from each list.

1. Gather: for every query, every block of vectors takes the ``k`` best of each of its lists of
   partial scores, and resolves the whole scores of these.
2. Cutoff: the k-th best of a query's gathered scores is safe, since k vectors reach it. It goes
   back to all blocks, and each list collects the entries of at least a ``lists``-th part of it: a
   score that reaches the cutoff has such a partial score.
3. Resolve: the remaining partial scores of the collected entries are added, those that reach
   the cutoff are kept, and the best ``k`` of them are the result.

Queries and vectors meet in blocks of bounded size, in a grid of tasks. A block gives at most k
entries of each query to the next step, and of equal scores those that win the tie, so vectors
that come very often cost no more than others. Nothing is sampled, and no score is approximate:
components are integers, and the arithmetic is chosen by their size, so that it is exact.

Defined results: vectors that are null or hold null or non-finite components take no part; an empty
vector, and what a shorter vector lacks, counts as zeros; a null id is no query, and comes last in ties;
rows of one id are vectors of their own, and a query leaves out its own row only; with fewer than
``k`` other vectors all are returned; components are limited to longs, and so is the score that
is shown; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, release

#: Rows of a block of vectors and of a block of queries.
VECTORS, QUERIES = 4096, 2048
#: Queries that a task scores at once.
STRIP = 256
#: Below every score.
LOWEST = -(1 << 200)
LONGS = (-(1 << 63), (1 << 63) - 1)


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & usable, whole)


def matrix(column: pa.ChunkedArray, width: int, kind) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(whole.offsets.to_numpy())
    values = whole.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), kind)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = values if kind is not object else values.tolist()
    return out


def arithmetic(queries: pa.ChunkedArray, vectors: pa.ChunkedArray, terms: int):
    """The fastest type in which sums of so many products of these are exact."""
    bound = max(terms, 1)
    for column in (queries, vectors):
        values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        bound *= max([1, *(abs(int(f(values))) for f in (np.min, np.max) if len(values))])
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


class Block:
    """A block of queries against a block of vectors, list by list."""

    def __init__(self, queries: pa.Table, vectors: pa.Table, lists: int) -> None:
        sizes = [c.combine_chunks().value_lengths().to_numpy() for c in (queries["v"], vectors["v"])]
        width = int(max(s.max() for s in sizes))
        kind = arithmetic(queries["v"], vectors["v"], width * lists)
        self.exact = kind is object
        self.nothing = LOWEST if self.exact else -np.inf
        self.own, self.rows = queries["row"].to_numpy(), vectors["row"].to_numpy()
        ids = vectors["vec_id"].combine_chunks()
        # Places of the vectors in the order that settles ties: smaller ids, null last, earlier rows.
        null = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((self.rows, ids.fill_null(0).to_numpy(), null))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        q, v = matrix(queries["v"], width, kind), matrix(vectors["v"], width, kind)
        cuts = np.linspace(0, width, lists + 1).astype(int)
        self.lists = [(q[:, a:b], v[:, a:b].T) for a, b in zip(cuts, cuts[1:])]

    def strips(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(query, its partial scores by list), some queries at a time; nothing for its own row."""
        for start in range(0, len(self.own), STRIP):
            found = [np.dot(q[start : start + STRIP], v) for q, v in self.lists]
            same = self.own[start : start + STRIP, None] == self.rows[None, :]
            for scores in found:
                scores[same] = self.nothing
            for i in range(len(same)):
                yield start + i, [scores[i] for scores in found]

    def whole(self, parts: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """The whole scores of some vectors, limited to longs; nothing for the query's own row."""
        total = sum(scores[at] for scores in parts)
        if self.exact:
            total = np.array([x if x <= LOWEST else min(max(x, LONGS[0]), LONGS[1]) for x in total], object)
        return total

    def gather(self, k: int) -> Iterator[tuple[int, list[int]]]:
        """Phase 1: each query's best k whole scores among the k best of each list."""
        n = len(self.rows)
        for query, parts in self.strips():
            some = np.zeros(n, bool)
            for scores in parts:
                some[np.argpartition(scores, n - k)[n - k :] if k < n else slice(None)] = True
            whole = self.whole(parts, np.flatnonzero(some))
            yield query, sorted((int(x) for x in whole if x > self.nothing), reverse=True)[:k]

    def resolve(self, cutoffs: list[int | None], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phases 2 and 3: each query's best k vectors that reach its cutoff, and their scores."""
        for query, parts in self.strips():
            least = cutoffs[query]
            some = parts[0] > self.nothing
            if least is not None:
                some &= np.any([scores * len(parts) >= least for scores in parts], axis=0)
            at = np.flatnonzero(some)
            whole = self.whole(parts, at)
            if least is not None:
                reach = whole >= least
                at, whole = at[reach], whole[reach]
            order = np.lexsort((self.place[at], -whole))[:k]
            yield query, at[order], whole[order]


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    lists: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row where ``is_query``, the ``k`` other rows of
    the highest inner product of the vectors' components, each as floor(scale * x)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        quantized(F.col(vector_col), scale).alias("v"),
        (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("asks"),
    )
    stored = scratch.store(usable.where("v IS NOT NULL"), "vectors")
    sizes = stored.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    high, wide = max(1, -(-sizes["q"] // QUERIES)), max(1, -(-sizes["n"] // VECTORS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    cells = stored.select("row", "vec_id", "v", block(wide).alias("_x"), every(high).alias("_y"))
    asked = scratch.store(stored.where("asks").select("row", "vec_id", "v"), "queries")

    def meet(queries: DataFrame, run, schema: str) -> DataFrame:
        placed = queries.select("*", block(high).alias("_y"), every(wide).alias("_x"))
        return placed.groupBy("_x", "_y").cogroup(cells.groupBy("_x", "_y")).applyInArrow(run, schema)

    def gather(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and vectors.num_rows:
            found = list(Block(queries, vectors, lists).gather(k))
        release()
        rows = queries["row"].take(pa.array([q for q, _ in found], pa.int64()))
        return pa.table({"row": rows, "scores": pa.array([s for _, s in found], pa.list_(pa.int64()))})

    gathered = meet(asked, gather, "row long, scores array<long>").select("row", F.explode("scores").alias("score"))
    kth = Window.partitionBy("row").orderBy(F.desc("score"))
    # A cutoff that may have been limited to longs cuts nothing.
    cutoffs = scratch.store(
        gathered.withColumn("_n", F.row_number().over(kth))
        .where((F.col("_n") <= k) & (F.col("_n") == k) & (F.col("score") > LONGS[0]))
        .select("row", F.col("score").alias("cutoff")),
        "cutoffs",
    )

    def resolve(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        asks, found, scores = [], [], []
        if queries.num_rows and vectors.num_rows:
            for q, at, whole in Block(queries, vectors, lists).resolve(queries["cutoff"].to_pylist(), k):
                asks += [q] * len(at)
                found += at.tolist()
                scores += [int(x) for x in whole]
        release()
        own, other = (t.take(pa.array(x, pa.int64())) for t, x in ((queries, asks), (vectors, found)))
        return pa.table(
            {"asked": own["row"], "query_id": own["vec_id"], "row": other["row"], "vec_id": other["vec_id"],
             "score": pa.array(scores, pa.int64())}
        )

    kept = meet(
        asked.join(cutoffs, "row", "left"), resolve, "asked long, query_id long, row long, vec_id long, score long"
    )
    best = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
