"""Random forests on sparse vectors against Spark ML's, and the draws that they share."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinia.operators import forests, models, trees

SIZE = 300


def vectors(spark, n=400, low=0, seed=9, parts=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        found = {j: float(rng.randint(low, 6)) / 2 for j in rng.sample(range(SIZE), 40)} | {0: 1.0}
        vector = Vectors.sparse(SIZE, found)
        label = float((found.get(7, 0) > 1 or found.get(11, 0) > 2 or sum(found.values()) > 60) ^ (rng.random() < 0.2))
        rows.append((i, label, Vectors.dense(vector.toArray()) if i % 10 == 0 else vector))
    return spark.createDataFrame(rows, ["doc_id", "label", "features"]).coalesce(1).repartition(parts).persist()


def scored(model, df):
    rows = model.transform(df).select(
        "doc_id", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p"), "prediction"
    )
    return {r["doc_id"]: (r["raw"], r["p"], r["prediction"]) for r in rows.collect()}


def same(settings, train, test):
    found = models.estimator("rf", **settings).fit(train)
    assert isinstance(found, forests.ForestModel)
    expected = RandomForestClassifier(**settings).fit(train)
    assert scored(found, test) == scored(expected, test)
    return found


@pytest.mark.parametrize(
    "settings",
    [
        {"maxDepth": 5, "seed": 31415},
        {"maxDepth": 9, "seed": 5, "numTrees": 33, "maxBins": 4},
        {"maxDepth": 3, "seed": -7, "numTrees": 3, "subsamplingRate": 0.4, "minInstancesPerNode": 7},
        {"maxDepth": 0, "seed": 1 << 40, "numTrees": 2},
        {"maxDepth": 6, "seed": 2, "maxMemoryInMB": 0, "numTrees": 18, "minInfoGain": 0.01},
    ],
)
def test_a_forest_is_that_of_spark_ml(spark, settings):
    df = vectors(spark, low=-3 if settings["maxDepth"] == 9 else 0)
    found = same(settings, df.where("doc_id % 4 <> 0"), df)
    assert (max(len(t.counts) for t in found.trees) > 3) == (settings["maxDepth"] > 0)


def test_groups_end_where_those_of_spark_ml_do(spark):
    """A group of nodes that exceeds the memory draws the features of its next node again."""
    df = vectors(spark, 1500)
    wide = df.select("doc_id", "label", "features")
    same({"maxDepth": 8, "seed": 3, "numTrees": 90, "maxMemoryInMB": 1, "featureSubsetStrategy": "sqrt"}, wide, wide)


def test_thresholds_of_a_sample(spark, monkeypatch):
    """Above 10,000 documents Spark ML takes thresholds from a sample."""
    rng = random.Random(4)
    rows = [(i, float(rng.random() < 0.3), Vectors.sparse(9, {j: rng.random() for j in rng.sample(range(9), 4)})) for i in range(12_000)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features"]).repartition(3).persist()
    chosen, counted = forests.sampled(df, 12_000, 32, 8)
    assert 9_500 < chosen.count() < 10_500 and math.isclose(counted, 10_000)
    same({"maxDepth": 4, "seed": 8, "numTrees": 5}, df, df.limit(500))


def test_draws_are_those_of_commons_math(spark):
    for seed, mean in ((31416, 1.0), (-5, 0.3), (1 << 45, 0.0015), (7, 1.0)):
        theirs = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(mean)
        theirs.reseedRandomGenerator(seed)
        mine = forests.poisson(seed, mean, spark._jvm.org.apache.commons.math3.util.FastMath.exp(-mean))
        assert list(itertools.islice(mine, 300)) == [theirs.sample() for _ in range(300)]
    theirs = spark._jvm.org.apache.commons.math3.random.Well19937c(1 << 40)
    mine = forests.Well(1 << 40)
    assert np.concatenate([mine.numbers(n) for n in (1, 700, 35, 36)]).tolist() == [theirs.nextDouble() for _ in range(772)]


def test_a_document_is_as_long_as_its_entries(spark):
    """Spark ML held a number for each of 262,144 features of every document."""
    wide = 1 << 18
    rows = [(i, float(i % 2), Vectors.sparse(wide, {i % 2: 1.0, 5 + i: 2.0})) for i in range(40)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    made = forests.Forest(df, 40, wide, models.estimator("rf", seed=1, numTrees=4))
    held = [len(a[3]) for a in trees.blocks(made.stored.toArrow().to_batches())]
    assert sum(held) == 80


def test_what_is_left_to_spark_ml(spark):
    df = vectors(spark, 60)
    for settings in ({"impurity": "entropy"}, {"numTrees": 1}, {"featureSubsetStrategy": "all"}, {"bootstrap": False}):
        assert not isinstance(models.estimator("rf", seed=1, maxDepth=2, **settings).fit(df), forests.ForestModel)
    three = df.withColumn("label", F.col("doc_id") % 3)
    assert models.estimator("rf", seed=1, maxDepth=2).fit(three).numClasses == 3
