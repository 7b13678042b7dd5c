"""Random forests on wide, sparse vectors, with the draws of Spark ML.

Spark ML's forest holds a bin for each feature of every document, as its trees do. Here documents keep the
bins of the entries that they have (:mod:`opinia.operators.trees`), and for each tree how often it has drawn them.
A group of nodes, by default those of one level in all trees, is one pass: an entry is counted in the nodes that
its document is in and that were given its feature, so a pass costs what the entries cost, not trees times features.

Everything that Spark ML draws is drawn here from the same generators in the same order: the documents that
thresholds come from (about 10,000, as Spark ML has it), how often a tree takes a document, and the features of a node.
So a forest is that of Spark ML on the same partitions: same trees, same scores. What is not found here (other impurities, weights,
more classes, categories, all features in every node) is left to Spark ML.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import classification as ml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.operators.trees import (
    DRAWS_KIND,
    PACKED,
    PURE,
    Sorted,
    Tree,
    TreeModel,
    added,
    binned,
    bins_of,
    blocks,
    chosen,
    descend,
    gini,
    in_blocks,
    own_session,
    packed,
    thresholds,
    value_counts,
    vector_size,
)

#: Documents that thresholds come from, at least, in Spark ML.
SAMPLED = 10_000
WORD = (1 << 32) - 1


class Well:
    """Commons Math's Well19937c, which Spark draws bootstrap samples from: numbers in [0, 1) from a seed."""

    #: How many words back the generator looks; the least of these is how many it makes at once.
    NEAR, MIDDLE, FAR, SIZE = 70, 179, 449, 623

    def __init__(self, seed: int) -> None:
        state = [seed >> 32 & WORD, seed & WORD]
        for i in range(2, self.SIZE + 1):
            x = state[i - 2] - ((state[i - 2] & 1 << 31) << 1)
            state.append(1812433253 * (x ^ (x >> 30)) + i & WORD)
        self.past, self.last = np.array(state[:0:-1], np.uint32), state[0]

    def numbers(self, n: int) -> np.ndarray:
        """The next ``n`` numbers."""
        size, step, count = self.SIZE, self.NEAR, 2 * n
        kept = np.concatenate([self.past, np.zeros(count, np.uint32)])
        words, last = [], self.last
        for t in range(size, size + count, step):
            end = min(t + step, size + count)

            def back(lag, t=t, end=end):
                return kept[t - lag : end - lag]

            first, x, z = back(self.NEAR), back(self.FAR), back(self.MIDDLE) >> 9
            first, z2 = first ^ first >> 27, z ^ x ^ x >> 1
            z0 = back(size) & 0x80000000 ^ back(size - 1) & 0x7FFFFFFF
            rest = z0 ^ z2 << 21 ^ z2 >> 21
            made = []
            # Only this chain is from one word to the next.
            for a, b in zip(first.tolist(), rest.tolist()):
                z1 = last ^ last << 25 & WORD ^ a
                last = z1 << 9 & WORD ^ z1 >> 21 ^ b
                made.append(z1)
                words.append(last)
            kept[t:end] = np.array(made, np.uint32) ^ z2
        self.past, self.last = kept[-size:], last
        w = np.array(words, np.uint32)
        w ^= w << 7 & np.uint32(0xE46E1700)
        w ^= w << 15 & np.uint32(0x9B868000)
        w = (w >> 6).astype(np.int64)
        return (w[::2] << 26 | w[1::2]) * 2.0**-52


def poisson(seed: int, mean: float, edge: float) -> Iterator[int]:
    """Commons Math's Poisson draws of a mean below 40; ``edge`` is exp(-mean)."""
    source, most = Well(seed), 1000 * mean
    n, r = 0, 1.0
    while True:
        for u in source.numbers(1 << 12).tolist():
            r *= u
            if r >= edge:
                n += 1
                if n < most:
                    continue
            yield n
            n, r = 0, 1.0


def bootstrap(trees: int, rate: float, edge: float, seed: int) -> Callable:
    """For :func:`opinia.operators.trees.binned`: how often each tree takes a document, as bytes."""

    def of(partition: int) -> Callable[[int], list[bytes]]:
        drawn = poisson(seed + partition + 1, rate, edge)

        def take(n: int) -> list[bytes]:
            return [np.fromiter(drawn, DRAWS_KIND, trees).tobytes() for _ in range(n)]

        return take

    return of


def sampled(vectors: DataFrame, n_docs: int, max_bins: int, seed: int) -> tuple[DataFrame, float]:
    """The vectors that Spark ML takes thresholds from, and the documents that they stand for."""
    required = max(min(max_bins, n_docs) ** 2, SAMPLED)
    if required >= n_docs:
        return vectors, float(n_docs)
    spark, plain = vectors.sparkSession, vectors.select("features")
    chosen_by = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    rows = plain._jdf.rdd().sample(False, required / n_docs, chosen_by)
    found = spark._jsparkSession.createDataFrame(rows, plain._jdf.schema())
    return DataFrame(found, spark), required / n_docs * n_docs


class Subsets:
    """The features of each node in turn."""

    def __init__(self, spark, size: int, width: int, seed: int) -> None:
        self.jvm, self.size, self.width = spark._jvm, size, width
        self.random = self.jvm.java.util.Random(seed)
        self.kind = self.jvm.scala.reflect.ClassTag.Int()

    def next(self) -> np.ndarray:
        every = getattr(self.jvm.scala.collection.immutable, "Range$Exclusive")(0, self.size, 1).iterator()
        sample = self.jvm.org.apache.spark.util.random.SamplingUtils.reservoirSampleAndCount
        found = sample(every, self.width, self.random.nextLong(), self.kind)._1()
        return np.array(self.jvm.java.util.Arrays.toString(found)[1:-1].split(","), dtype=np.int64)

    def order(self, trees: list[int]) -> list[int]:
        """The trees of a group in the order in which Spark ML goes on with them: that of Scala's maps."""
        mutable = self.jvm.scala.collection.mutable.HashMap()
        for tree in trees:
            mutable.put(tree, tree)
        same = getattr(getattr(self.jvm.scala, "$less$colon$less$"), "MODULE$").refl()
        return [int(x) for x in mutable.toMap(same).keys().mkString(",").split(",")]


class Forest:
    """The trees of a forest on ``(..., label, features)``, whole once it is made."""

    def __init__(self, vectors: DataFrame, n_docs: int, size: int, model: SparseRandomForest) -> None:
        spark = vectors.sparkSession
        self.size, self.least = size, (model.getMinInstancesPerNode(), model.getMinInfoGain())
        seed, rate, n_trees = model.getSeed(), model.getSubsamplingRate(), model.getNumTrees()
        found, counted = sampled(vectors, n_docs, model.getMaxBins(), seed)
        self.starts, self.limits = thresholds(value_counts(found), n_docs, model.getMaxBins(), size, counted)
        self.zero = bins_of(np.arange(size), np.zeros(size), self.starts, self.limits)
        self.bins = int(np.diff(self.starts).max(initial=0)) + 1
        edge = spark._jvm.org.apache.commons.math3.util.FastMath.exp(-rate)
        drawn = binned(vectors, self.starts, self.limits, self.zero, bootstrap(n_trees, rate, edge, seed))
        self.stored = own_session(in_blocks(drawn))
        self.steady = spark.sparkContext.broadcast((self.zero, size, self.bins))
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.trees = [Tree() for _ in range(n_trees)]
        for tree, (n0, n1) in zip(self.trees, self._totals(n_trees)):
            tree.add(n0, n1)
        self._grow(Subsets(spark, size, math.ceil(math.sqrt(size)), seed), model.getMaxDepth(), model.getMaxMemoryInMB() << 20)
        for tree in self.trees:
            tree.prune()

    def _totals(self, n_trees: int) -> list[tuple[int, int]]:
        """The documents of each tree with label 0 and with label 1, as often as it has them."""

        def add(batches):
            for label, width, _, _, drawn in blocks(batches):
                drawn = drawn.reshape(len(width), n_trees).astype(np.int64)
                sums = [pa.array([drawn[label == k].sum(axis=0).tolist()], pa.list_(pa.int64())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(sums, ["n0", "n1"])

        found = self.stored.mapInArrow(add, "n0 array<long>, n1 array<long>")
        rows = found.agg(*[F.sum(F.col(c)[t]) for t in range(n_trees) for c in ("n0", "n1")]).first()
        return list(zip(rows[::2], rows[1::2]))

    def _grow(self, subsets: Subsets, max_depth: int, most: int) -> None:
        level = [{0: 0} for _ in self.trees]
        #: Nodes to split, the next one last.
        stack = [(t, 0) for t in range(len(self.trees))]
        while stack:
            group, used = [], 0
            while stack:
                features = subsets.next()
                # As much as Spark ML's counts of the node take, which decides where a group ends.
                needed = 16 * int((self.starts[features + 1] - self.starts[features] + 1).sum())
                if used and used + needed > most:
                    break
                group.append((*stack.pop(), features))
                used += needed
            splits = {r["slot"]: r for r in self._splits(group)}
            for t in subsets.order(list(dict.fromkeys(t for t, _, _ in group))):
                tree = self.trees[t]
                for slot, (of, node, features) in enumerate(group):
                    if of != t or slot not in splits or level[t][node] == max_depth:
                        continue
                    r = splits[slot]
                    feature = int(features[r["index"]])
                    limit = float(self.limits[self.starts[feature] + r["bin"]])
                    for child in tree.split(node, feature, r["bin"], limit, r["n0"], r["n1"]):
                        level[t][child] = level[t][node] + 1
                        if level[t][child] < max_depth and abs(float(gini(*tree.counts[child]))) >= PURE:
                            stack.append((t, child))

    def _splits(self, group: list[tuple[int, int, np.ndarray]]) -> list:
        """The best split of each node of a group that has one; ``index`` is the place among its features."""
        spark, (least, least_gain), buckets, n_trees = self.stored.sparkSession, self.least, self.buckets, len(self.trees)
        places = len(group[0][2])
        tree_of = np.array([t for t, _, _ in group])
        growing = {}
        for t in np.unique(tree_of).tolist():
            slot_of = np.full(len(self.trees[t].counts), -1)
            for slot, (of, node, _) in enumerate(group):
                if of == t:
                    slot_of[node] = slot
            growing[t] = (self.trees[t].arrays(), slot_of)
        features = np.concatenate([f for _, _, f in group])
        # The slots and places of a feature, beside each other.
        asked = np.argsort(features, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(features, minlength=self.size))])
        n0, n1 = (np.array([self.trees[t].counts[node][k] for t, node, _ in group], dtype=float) for k in (0, 1))
        here = spark.sparkContext.broadcast((growing, tree_of, asked, first, self.zero[features], n0, n1))
        steady = self.steady

        def count(batches):
            growing, tree_of, asked, first, _, _, _ = here.value
            zero, size, bins = steady.value
            for label, width, index, value, drawn in blocks(batches):
                index, value = index.astype(np.int64), value.astype(np.int64)
                drawn = drawn.reshape(len(width), n_trees)
                row = np.repeat(np.arange(len(width)), width)
                known = Sorted(row, index, value, size)
                at = np.full(drawn.shape, -1)
                for t, (nodes, slot_of) in growing.items():

                    def right(rows, at, nodes=nodes):
                        f = nodes["feature"][at]
                        return known.get(rows, f, zero[f]) > nodes["bin"][at]

                    at[:, t] = slot_of[descend(nodes, len(width), right)]
                at[drawn == 0] = -1
                # Each entry once for every node that was given its feature.
                n = first[index + 1] - first[index]
                entry = np.repeat(np.arange(len(index)), n)
                place = asked[np.arange(len(entry)) + np.repeat(first[index] - np.cumsum(n) + n, n)]
                use = at[row[entry], tree_of[place // places]] == place // places
                entry, place = entry[use], place[use]
                times = drawn[row[entry], tree_of[place // places]].astype(np.int64)
                ones = np.where(label[row[entry]] == 1, times, 0)
                code, zeros, ones = added(place * bins + value[entry], times - ones, ones)
                yield from packed(code, zeros.astype(np.int32), ones.astype(np.int32), bins, buckets)

        def held():
            _, _, _, _, zeros, n0, n1 = here.value
            return {"size": places, "bins": steady.value[2], "zero": zeros, "n0": n0, "n1": n1, "least": least, "least_gain": least_gain}

        rows = chosen(self.stored.mapInArrow(count, PACKED), held)
        here.unpersist()
        return rows


class ForestModel(TreeModel):
    """Adds the columns of Spark ML's forests: a tree's vote is the share of each class in its leaf."""

    def __init__(self, trees: list[Tree], size: int) -> None:
        super().__init__(trees[0], size)
        self.trees = trees

    def voters(self) -> list[dict[str, np.ndarray]]:
        found = [tree.arrays() for tree in self.trees]
        return [nodes | {"votes": nodes["counts"] / np.maximum(nodes["counts"].sum(axis=1), 1)[:, None]} for nodes in found]


class SparseRandomForest(ml.RandomForestClassifier):
    """Spark ML's random forest and its parameters, grown by :class:`Forest` where that knows them."""

    def _known(self, dataset: DataFrame) -> bool:
        """Whether the settings and the kinds of columns are those of :class:`Forest`."""
        wanted = {
            "impurity": "gini", "minWeightFractionPerNode": 0.0, "bootstrap": True, "leafCol": "",
            "featuresCol": "features", "labelCol": "label", "predictionCol": "prediction",
            "probabilityCol": "probability", "rawPredictionCol": "rawPrediction",
        }
        if any(self.getOrDefault(name) != value for name, value in wanted.items()):
            return False
        if any(self.isSet(name) for name in ("weightCol", "thresholds")) or self.getNumTrees() < 2:
            return False
        kinds = dataset.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
        plain = not {"nominal", "binary"} & set(kinds) and not dataset.schema["label"].metadata
        return plain and self.getFeatureSubsetStrategy() in ("auto", "sqrt")

    def _fit(self, dataset: DataFrame):
        if not self._known(dataset):
            return super()._fit(dataset)
        vectors = dataset.select(F.col("label").cast("double").alias("label"), "features")
        good = F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False)) & F.col("features").isNotNull()
        facts = vectors.agg(F.count("*").alias("n"), F.count_if(~good).alias("odd"), F.max("label").alias("most")).first()
        if not facts["n"] or facts["odd"] or facts["most"] != 1.0:
            return super()._fit(dataset)
        size = vector_size(vectors)
        if math.ceil(math.sqrt(size)) == size:
            return super()._fit(dataset)
        return ForestModel(Forest(vectors, facts["n"], size, self).trees, size)
