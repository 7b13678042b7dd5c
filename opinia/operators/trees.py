"""Decision trees on wide, sparse vectors.

Spark ML's trees hold one number for every feature of every document, whether the document has it
or not. Here a document keeps the bins of the entries that it has and that can part anything; a bin
that is not listed is that of zero, and its counts are the node's less those of the others. The
tree grows by level: tasks count ``(node, feature, bin)`` by class, a shuffle by node and feature
adds the counts up and finds the best split of each, and the driver sees one split a node.

Splits, gains, ties, leaves and pruning follow Spark ML, so a tree is the same as Spark ML's up to
10,000 documents; above, Spark ML takes its thresholds from a sample, and this from all documents.
"""

from __future__ import annotations

import copy
import math
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml import classification as ml
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.session import materialize

#: Entries that a task works on at a time.
CHUNK = 1 << 19
#: Impurity below which a node is a leaf.
PURE = 2.0**-52


def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entries per row, index, value)`` of vectors in their storage form, zeros left out."""
    values = column.field("values")
    sizes = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    found = values.flatten().to_numpy(zero_copy_only=False)
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    starts = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(len(found)) - np.repeat(starts[:-1], sizes)
    index[np.repeat(sparse, sizes)] = column.field("indices").flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)[found != 0]
    return np.bincount(row, minlength=len(sizes)), index[found != 0], found[found != 0]


def chunks(batches: Iterator[pa.RecordBatch], width: Callable) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``CHUNK`` entries; ``width`` counts those of each row."""
    for batch in batches:
        ends = np.cumsum(width(batch)) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def vector_width(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("features").field("values")
    return values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def value_counts(vectors: DataFrame) -> DataFrame:
    """``(index, value, n)`` of all entries but zeros, stored."""

    def count(batches):
        for batch in chunks(batches, vector_width):
            _, index, value = entries(batch.column("features"))
            order = np.lexsort((value, index))
            index, value = index[order], value[order]
            first = np.flatnonzero(np.r_[True, (index[1:] != index[:-1]) | (value[1:] != value[:-1])][: len(index)])
            n = np.diff(np.r_[first, len(index)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(index[first], pa.int32()), pa.array(value[first]), pa.array(n, pa.int64())], ["index", "value", "n"]
            )

    found = vectors.select("features").mapInArrow(count, "index int, value double, n long")
    return materialize(found.groupBy("index", "value").agg(F.sum("n").alias("n")), "value-counts")


def thresholds_of(counted: list[tuple[float, int]], rest: float, n_docs: float, most: int) -> list[float]:
    """The thresholds of a feature from its values and their counts; ``rest`` documents have zero.

    Between all values if at most ``most`` are needed, and otherwise near the quantiles.
    """
    counted = sorted([*counted, (0.0, rest)] if rest > 0 else counted)
    between = [(a + b) / 2.0 for (a, _), (b, _) in zip(counted, counted[1:])]
    if len(between) <= most:
        return between
    stride = n_docs / (most + 1)
    found, seen, target = [], counted[0][1], stride
    for middle, (_, n) in zip(between, counted[1:]):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            found.append(middle)
            target += stride
    return found


def thresholds(
    counts: DataFrame, n_docs: int, max_bins: int, size: int, counted_docs: float | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, thresholds)``: those of feature ``i`` are ``thresholds[starts[i]:starts[i + 1]]``. ``counted_docs``
    are the documents that the counts stand for, where these are not those of all."""
    most = min(max_bins, n_docs) - 1
    expected = n_docs if counted_docs is None else counted_docs

    def find(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("index", "values", "n")))
            rows = ((i, vs, expected - n if expected - n > 100 * PURE * n else 0) for i, vs, n in rows)
            found = [(i, thresholds_of([(v["value"], v["n"]) for v in vs], rest, expected, most)) for i, vs, rest in rows]
            kept = [(i, ts) for i, ts in found if ts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in kept], pa.int32()), pa.array([ts for _, ts in kept], pa.list_(pa.float64()))],
                ["index", "thresholds"],
            )

    by_index = counts.groupBy("index").agg(
        F.collect_list(F.struct("value", "n")).alias("values"), F.sum("n").alias("n")
    )
    table = by_index.mapInArrow(find, "index int, thresholds array<double>").toArrow().sort_by("index")
    lists = table.column("thresholds").combine_chunks()
    widths = np.zeros(size, dtype=np.int64)
    widths[table.column("index").to_numpy()] = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(widths)]), lists.flatten().to_numpy(zero_copy_only=False).astype(float)


def bins_of(index: np.ndarray, value: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many thresholds of its feature each value exceeds."""
    bins = np.zeros(len(index), dtype=np.int64)
    left = np.flatnonzero(starts[index + 1] > starts[index])
    while len(left):
        at = starts[index[left]] + bins[left]
        left = left[value[left] > limits[at]]
        bins[left] += 1
        left = left[starts[index[left]] + bins[left] < starts[index[left] + 1]]
    return bins


def binned(
    vectors: DataFrame, starts: np.ndarray, limits: np.ndarray, zero: np.ndarray, draws: Callable | None = None
) -> DataFrame:
    """``(label, index, bin)`` of every document, stored: the entries whose bin is not that of zero. With ``draws``, also
    ``draws``: what the function that it gives for the number of a partition returns for its next documents."""
    held = vectors.sparkSession.sparkContext.broadcast((starts, limits, zero))

    def place(batches):
        starts, limits, zero = held.value
        draw = draws(TaskContext.get().partitionId()) if draws else None
        for batch in chunks(batches, vector_width):
            sizes, index, value = entries(batch.column("features"))
            if draws and not np.isfinite(value).all():
                raise ValueError("vectors must not hold NaN or infinity")
            bins = bins_of(index, value, starts, limits)
            kept = bins != zero[index]
            row = np.repeat(np.arange(len(sizes)), sizes)[kept]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))])
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(a[kept], pa.int32())) for a in (index, bins)]
            columns = {"label": batch.column("label").cast(pa.int8()), "index": lists[0], "bin": lists[1]}
            if draws:
                columns["draws"] = pa.array(draw(batch.num_rows), pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "label byte, index array<int>, bin array<int>" + (", draws binary" if draws else "")
    return materialize(vectors.select("label", "features").mapInArrow(place, schema), "binned")


#: Documents in blocks: how many, with label 1, entries of all; labels, entries per document, features and bins as arrays,
#: and draws where the table has them.
BLOCK = "n long, ones long, held long, label binary, width binary, index binary, bin binary"
BLOCK_KINDS = {"label": np.int8, "width": np.int32, "index": np.int32, "bin": np.int32}
DRAWS_KIND = np.int16


def in_blocks(stored: DataFrame) -> DataFrame:
    """The table of :func:`binned` with many documents a row, stored, as every level reads it whole."""

    def width(batch):
        return batch.column("index").value_lengths().to_numpy(zero_copy_only=False)

    def pack(batches):
        for batch in chunks(batches, width):
            arrays = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("index", "bin")}
            arrays |= {"width": width(batch), "label": batch.column("label").to_numpy(zero_copy_only=False)}
            sums = (batch.num_rows, arrays["label"].sum(), len(arrays["index"]))
            columns = [pa.array([int(n)], pa.int64()) for n in sums]
            columns += [pa.array([arrays[c].astype(kind).tobytes()], pa.binary()) for c, kind in BLOCK_KINDS.items()]
            if drawn:
                columns.append(pa.array([b"".join(batch.column("draws").to_pylist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["n", "ones", "held", *BLOCK_KINDS, *drawn])

    drawn = [c for c in stored.columns if c == "draws"]
    return materialize(stored.mapInArrow(pack, BLOCK + "".join(f", {c} binary" for c in drawn)), "blocks")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The arrays of the blocks of :func:`in_blocks`, one block at a time."""
    for batch in batches:
        kinds = BLOCK_KINDS | ({"draws": DRAWS_KIND} if "draws" in batch.schema.names else {})
        for k in range(batch.num_rows):
            yield [np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in kinds.items()]


def gini(n0, n1):
    total = np.maximum(n0 + n1, 1)
    a, b = n0 / total, n1 / total
    return np.where(n0 + n1 > 0, 1.0 - a * a - b * b, 0.0)


class Tree:
    """The nodes, the root first: ``feature`` is -1 in a leaf; a document goes left if its bin is at most ``bin``,
    or its value at most ``threshold``."""

    def __init__(self) -> None:
        self.feature, self.bin, self.threshold, self.left, self.right = [], [], [], [], []
        self.counts: list[tuple[int, int]] = []

    def add(self, n0: int, n1: int) -> int:
        for values, value in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1)):
            values.append(value)
        self.counts.append((int(n0), int(n1)))
        return len(self.counts) - 1

    def split(self, node: int, feature: int, bin: int, threshold: float, n0: int, n1: int) -> tuple[int, int]:
        all0, all1 = self.counts[node]
        self.feature[node], self.bin[node], self.threshold[node] = feature, bin, threshold
        self.left[node], self.right[node] = self.add(n0, n1), self.add(all0 - n0, all1 - n1)
        return self.left[node], self.right[node]

    def prune(self) -> None:
        """Two leaves that predict the same become one. Children come after their parents."""
        for node in reversed(range(len(self.counts))):
            below = (self.left[node], self.right[node])
            if self.feature[node] >= 0 and all(self.feature[c] < 0 for c in below):
                said = {self.counts[c][1] > self.counts[c][0] for c in below}
                if len(said) == 1:
                    self.feature[node] = -1

    def cut(self, depth: int) -> Tree:
        """The tree down to a depth, pruned."""
        found = copy.deepcopy(self)
        level = {0: 0}
        for node in range(len(found.counts)):
            if found.feature[node] >= 0:
                level |= {found.left[node]: level[node] + 1, found.right[node]: level[node] + 1}
                if level[node] >= depth:
                    found.feature[node] = -1
        found.prune()
        return found

    def arrays(self) -> dict[str, np.ndarray]:
        names = ("feature", "bin", "threshold", "left", "right")
        return {n: np.array(getattr(self, n)) for n in names} | {"counts": np.array(self.counts, dtype=float)}


def descend(nodes: dict, rows: int, right: Callable) -> np.ndarray:
    """The node that each of ``rows`` documents ends in; ``right(rows, nodes)`` tells which go right."""
    at = np.zeros(rows, dtype=np.int64)
    moving = np.arange(rows)
    while len(moving := moving[nodes["feature"][at[moving]] >= 0]):
        here = at[moving]
        at[moving] = np.where(right(moving, here), nodes["right"][here], nodes["left"][here])
    return at


class Sorted:
    """Entries of some documents, looked up by document and feature."""

    def __init__(self, row: np.ndarray, index: np.ndarray, value: np.ndarray, size: int) -> None:
        self.keys, self.value, self.size = row * size + index, value, size

    def get(self, row: np.ndarray, index: np.ndarray, default: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return default
        wanted = row * self.size + index
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.value[at], default)


def added(code: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct codes in order, and the sums of each of the counts by code."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
    return code[first], *(np.add.reduceat(n[order], first) if len(first) else n for n in counts)


def best_splits(code, n0, n1, held: dict) -> pa.RecordBatch:
    """The best split of every slot among some of its features, all of whose counts are here; a ``code`` is
    slot, feature and bin in one number. ``zero`` has the bins of zero by feature, or by slot and feature."""
    size, bins = held["size"], held["bins"]
    code, n0, n1 = added(code, n0.astype(float), n1.astype(float))
    start = np.flatnonzero(np.r_[True, np.diff(code // bins) != 0][: len(code)])
    group = code[start] // bins
    # The documents that lack the feature.
    rest0 = held["n0"][group // size] - np.add.reduceat(n0, start)
    rest1 = held["n1"][group // size] - np.add.reduceat(n1, start)
    some = rest0 + rest1 > 0
    code = np.concatenate([code, (group * bins + held["zero"][group % len(held["zero"])])[some]])
    order = np.argsort(code, kind="stable")
    code, n0, n1 = code[order], np.concatenate([n0, rest0[some]])[order], np.concatenate([n1, rest1[some]])[order]
    first = np.r_[True, np.diff(code // bins) != 0][: len(code)]
    start, inverse = np.flatnonzero(first), np.cumsum(first) - 1
    left0, left1 = np.cumsum(n0), np.cumsum(n1)
    left0, left1 = (s - (s[start] - n[start])[inverse] for s, n in ((left0, n0), (left1, n1)))
    slot = code // bins // size
    all0, all1 = held["n0"][slot], held["n1"][slot]
    right0, right1 = all0 - left0, all1 - left1
    a, b, total = left0 + left1, right0 + right1, all0 + all1
    gain = gini(all0, all1) - a / total * gini(left0, left1) - b / total * gini(right0, right1)
    fits = (a >= held["least"]) & (b >= held["least"]) & (gain > 0) & (gain >= held["least_gain"])
    at = np.flatnonzero(fits)
    # The largest gain, of equal ones the first feature and bin.
    at = at[np.lexsort((code[at], -gain[at], slot[at]))]
    at = at[np.unique(slot[at], return_index=True)[1]]
    columns = (slot, gain, code // bins % size, code % bins, left0, left1)
    kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    found = [pa.array(c[at].astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(found, ["slot", "gain", "index", "bin", "n0", "n1"])


class Growth:
    """A tree on ``(..., label, features)`` that grows a level at a time, and can be taken at any depth.

    The driver and every task hold the thresholds, the zero bins and the nodes; nothing else. ``counts`` gives the
    :func:`value_counts` of the vectors where they may be known.
    """

    def __init__(
        self,
        vectors: DataFrame,
        max_bins: int,
        min_instances: int = 1,
        min_gain: float = 0.0,
        counts: Callable[[], DataFrame] | None = None,
    ) -> None:
        self.least = (min_instances, min_gain)
        vectors = vectors.withColumn("label", F.col("label").cast("double"))
        good = F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False))
        facts = vectors.agg(F.count("*").alias("n"), F.count_if(~good).alias("odd")).first()
        if facts["odd"]:
            raise ValueError("trees need the labels 0 and 1")
        if not facts["n"]:
            raise ValueError("trees need documents")
        self.size = size = vector_size(vectors)
        self.starts, self.limits = thresholds(counts() if counts else value_counts(vectors), facts["n"], max_bins, size)
        zero = bins_of(np.arange(size), np.zeros(size), self.starts, self.limits)
        bins = int(np.diff(self.starts).max(initial=0)) + 1
        self.stored = own_session(in_blocks(binned(vectors, self.starts, self.limits, zero)))
        self.steady = vectors.sparkSession.sparkContext.broadcast((zero, size, bins))
        self.tree, self.depth = Tree(), 0
        facts = self.stored.agg(F.sum("n") - F.sum("ones"), F.sum("ones"), F.sum("held")).first()
        #: Parts of the counts, so many that one is small; a level has no more counts than there are entries.
        parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = max(4 * parts, facts[2] // (CHUNK // 8))
        #: Nodes to split.
        self.open = [self.tree.add(facts[0], facts[1])]

    def at(self, depth: int) -> Tree:
        """The pruned tree of a depth; grows what is missing."""
        while self.depth < depth and self.open:
            self._grow_level()
        return self.tree.cut(depth)

    def _grow_level(self) -> None:
        self.open = [node for node in self.open if abs(float(gini(*self.tree.counts[node]))) >= PURE]
        self.depth += 1
        if not self.open:
            return
        following = []
        for r in _level(self.stored, self.tree, self.open, self.steady, self.buckets, *self.least):
            limit = float(self.limits[self.starts[r["index"]] + r["bin"]])
            following += self.tree.split(self.open[r["slot"]], r["index"], r["bin"], limit, r["n0"], r["n1"])
        self.open = following


def own_session(stored: DataFrame) -> DataFrame:
    """A stored table in a session of its own, in which a query's shuffle files go when it ends: a deep tree
    is a hundred small queries, whose files would otherwise stay until the driver collects garbage."""
    spark = stored.sparkSession
    own = spark.newSession()
    # Rows of packed counts are large.
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return own.read.schema(stored.schema).parquet(*stored.inputFiles())


def _level(stored, tree, open_nodes, steady, buckets, min_instances, min_gain) -> list:
    """The best split of each open node that has one."""
    slot_of = np.full(len(tree.counts), -1)
    slot_of[open_nodes] = np.arange(len(open_nodes))
    n0, n1 = (np.array([tree.counts[node][k] for node in open_nodes], dtype=float) for k in (0, 1))
    here = stored.sparkSession.sparkContext.broadcast((tree.arrays(), slot_of, n0, n1))

    def count(batches):
        nodes, slot_of, _, _ = here.value
        zero, size, bins = steady.value
        for label, width, index, value in blocks(batches):
            index, value = index.astype(np.int64), value.astype(np.int64)
            row = np.repeat(np.arange(len(width)), width)
            known = Sorted(row, index, value, size)

            def right(rows, at):
                f = nodes["feature"][at]
                return known.get(rows, f, zero[f]) > nodes["bin"][at]

            slot = slot_of[descend(nodes, len(width), right)][row]
            use = slot >= 0
            # Numbers alone are sorted several times faster than their order is found.
            marked = np.sort(((slot[use] * size + index[use]) * bins + value[use]) * 2 + label[row[use]])
            first = np.flatnonzero(np.r_[True, marked[1:] != marked[:-1]][: len(marked)])
            n = np.diff(np.r_[first, len(marked)])
            marked = marked[first]
            ones = np.where(marked % 2 == 1, n, 0)
            code, zeros, ones = added(marked // 2, n - ones, ones)
            yield from packed(code, zeros.astype(np.int32), ones.astype(np.int32), bins, buckets)

    def held():
        _, _, n0, n1 = here.value
        zero, size, bins = steady.value
        return {"size": size, "bins": bins, "zero": zero, "n0": n0, "n1": n1, "least": min_instances, "least_gain": min_gain}

    rows = chosen(stored.mapInArrow(count, PACKED), held)
    here.unpersist()
    return rows


#: What :func:`packed` makes.
PACKED = "bucket int, code binary, n0 binary, n1 binary"


def chosen(counted: DataFrame, held: Callable[[], dict]) -> list:
    """The best split of each slot that has one, from all tasks' :func:`packed` counts; see :func:`best_splits`."""

    def choose(batches):
        known = held()
        for code, zeros, ones in whole_buckets(batches):
            if len(code):
                yield best_splits(code, zeros, ones, known)

    dealt = counted.repartition("bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(choose, "slot int, gain double, index int, bin int, n0 long, n1 long")
    first = F.min(F.struct((-F.col("gain")).alias("g"), "index", "bin", "n0", "n1")).alias("s")
    rows = found.groupBy("slot").agg(first).select("slot", "s.*").collect()
    return sorted(rows, key=lambda r: r["slot"])


def packed(code: np.ndarray, n0: np.ndarray, n1: np.ndarray, bins: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """``(bucket, code, n0, n1)``: the counts as arrays, a row a bucket, so that a shuffle moves few rows. A
    bucket has all counts of its slots and features."""
    bucket = code // bins % buckets
    # Short numbers are sorted by digits.
    bucket = bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    # An empty part is no row.
    parts = np.split(order, cuts) if len(order) else []
    columns = [pa.array([int(bucket[part[0]]) for part in parts], pa.int32())]
    columns += [pa.array([numbers[part].tobytes() for part in parts], pa.binary()) for numbers in (code, n0, n1)]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "code", "n0", "n1"])


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The counts of some whole buckets at a time, from :func:`packed` rows sorted by bucket."""
    kinds, held, last, n = (np.int64, np.int32, np.int32), ([], [], []), None, 0
    for batch in batches:
        for bucket, *blobs in zip(*(batch.column(c).to_pylist() for c in ("bucket", "code", "n0", "n1"))):
            if bucket != last and n >= CHUNK:
                yield tuple(np.concatenate(h) for h in held)
                held, n = ([], [], []), 0
            for h, blob, kind in zip(held, blobs, kinds):
                h.append(np.frombuffer(blob, kind))
            last, n = bucket, n + len(held[0][-1])
    if n:
        yield tuple(np.concatenate(h) for h in held)


def vector_size(vectors: DataFrame) -> int:
    """The width of the vectors, from the first of them."""
    return int(vectors.select("features").first()[0].size)


class TreeModel(Model):
    """Adds ``rawPrediction`` (the counts of the leaf), ``probability`` and ``prediction``, as Spark ML's trees do."""

    def __init__(self, tree: Tree, size: int) -> None:
        super().__init__()
        self.tree, self.numFeatures = tree, size

    def voters(self) -> list[dict[str, np.ndarray]]:
        """The arrays of each tree, and in ``votes`` what its nodes say; the votes of all are added up in this order."""
        nodes = self.tree.arrays()
        return [nodes | {"votes": nodes["counts"]}]

    def _transform(self, df: DataFrame) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self.voters())
        size = self.numFeatures

        @F.arrow_udf("array<double>")
        def raw(features: pa.Array) -> pa.Array:
            sizes, index, value = entries(features)
            known = Sorted(np.repeat(np.arange(len(sizes)), sizes), index, value, size)
            votes = np.zeros((len(sizes), 2))
            for nodes in held.value:

                def right(rows, at, nodes=nodes):
                    return known.get(rows, nodes["feature"][at], np.zeros(len(at))) > nodes["threshold"][at]

                votes += nodes["votes"][descend(nodes, len(sizes), right)]
            return pa.FixedSizeListArray.from_arrays(pa.array(votes.ravel()), 2).cast(pa.list_(pa.float64()))

        # Stored, since an aggregate over the result would take the function in, where it cannot be run.
        voted = materialize(df.withColumn("_votes", raw("features")), "votes")
        votes = F.col("_votes")
        total = votes[0] + votes[1]
        share = F.when(total > 0, F.array(votes[0] / total, votes[1] / total)).otherwise(votes)
        return (
            voted.withColumn("rawPrediction", array_to_vector(votes))
            .withColumn("probability", array_to_vector(share))
            .withColumn("prediction", (votes[1] > votes[0]).cast("double"))
            .drop("_votes")
        )


def _settled(model, **wanted) -> None:
    """An error for a setting that these trees do not have."""
    wanted |= {"impurity": "gini", "minWeightFractionPerNode": 0.0, "featuresCol": "features", "labelCol": "label"}
    for name, value in wanted.items():
        if model.getOrDefault(name) != value:
            raise ValueError(f"{name} has to be {value!r}")
    for name in ("weightCol", "thresholds"):
        if model.isSet(name):
            raise ValueError(f"{name} is not known here")


class SparseDecisionTree(ml.DecisionTreeClassifier):
    """Spark ML's decision tree and its parameters, grown by :class:`Growth`."""

    #: Growths that fits on the same table go on with, by their settings; see :meth:`sharing`.
    _shared: dict | None = None
    _lock = threading.Lock()

    def sharing(self) -> SparseDecisionTree:
        """A copy whose fits, all on one table, grow a tree once for all depths."""
        found = self.copy()
        found._shared = {}
        return found

    def _fit(self, dataset: DataFrame) -> TreeModel:
        _settled(self)
        settings = (self.getMaxBins(), self.getMinInstancesPerNode(), self.getMinInfoGain())
        with self._lock:
            shared = {} if self._shared is None else self._shared
            growing, found = shared.setdefault(settings, (threading.Lock(), []))
            counting, counted = shared.setdefault("counts", (threading.Lock(), []))

        def counts() -> DataFrame:
            with counting:
                if not counted:
                    counted.append(value_counts(dataset))
            return counted[0]

        with growing:
            if not found:
                found.append(Growth(dataset, settings[0], settings[1], settings[2], counts))
            return TreeModel(found[0].at(self.getMaxDepth()), found[0].size)
