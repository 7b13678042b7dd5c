"""Trees on sparse vectors against Spark ML's, their rows, and what a task holds."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinia.operators import models, trees

SIZE = 300


def vectors(spark, n=240, low=0, seed=9):
    """Few features of many, some of them negative where ``low`` is; every tenth vector is dense."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        found = {j: float(rng.randint(low, 6)) / 2 for j in rng.sample(range(SIZE), 25)} | {0: 1.0}
        vector = Vectors.sparse(SIZE, found)
        label = float((found.get(7, 0) > 1 or found.get(11, 0) > 2) ^ (rng.random() < 0.2))
        rows.append((i, label, Vectors.dense(vector.toArray()) if i % 10 == 0 else vector))
    return spark.createDataFrame(rows, ["doc_id", "label", "features"])


def scored(model, df):
    rows = model.transform(df).select(
        "doc_id", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p"), "prediction"
    )
    return {r["doc_id"]: (r["raw"], r["p"], r["prediction"]) for r in rows.collect()}


@pytest.mark.parametrize("low", [0, -3])
@pytest.mark.parametrize(("depth", "bins"), [(5, 32), (30, 3), (0, 10)])
def test_a_tree_is_that_of_spark_ml(spark, low, depth, bins):
    df = vectors(spark, low=low)
    train, test = df.where("doc_id % 3 <> 0"), df.where("doc_id % 3 = 0")
    settings = {"maxDepth": depth, "maxBins": bins}
    found = models.estimator("dt", **settings).fit(train)
    assert scored(found, test) == scored(DecisionTreeClassifier(**settings).fit(train), test)


def test_a_document_is_as_long_as_its_entries(spark):
    """Spark ML held a number for each of 262,144 features of every document."""
    wide = 1 << 18
    rows = [(i, float(i % 2), Vectors.sparse(wide, {i % 2: 1.0, 5 + i: 2.0})) for i in range(40)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    starts, limits = trees.thresholds(trees.value_counts(df), 40, 32, wide)
    stored = trees.binned(df, starts, limits, np.zeros(wide, dtype=int))
    assert stored.agg(F.max(F.size("bin"))).first()[0] == 2
    tree = trees.Growth(df, 32).at(5)
    assert tree.feature[0] == 0 and len(tree.counts) == 3


def test_a_feature_that_spans_batches(spark):
    """Counts of one feature that reach a task in several Arrow batches are one histogram."""
    df = vectors(spark)
    expected = trees.Growth(df, 32).at(6).arrays()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = trees.Growth(df, 32).at(6).arrays()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert all((expected[k] == found[k]).all() for k in expected)


def test_shared_fits_grow_once(spark, monkeypatch):
    df = vectors(spark)
    made, grown = [], trees.Growth
    monkeypatch.setattr(trees, "Growth", lambda *a, **b: made.append(1) or grown(*a, **b))
    dt = models.estimator("dt").sharing()
    for depth in (4, 12, 2):
        found = dt.fit(df, {dt.maxDepth: depth})
        assert scored(found, df) == scored(DecisionTreeClassifier(maxDepth=depth).fit(df), df)
    assert len(made) == 1


def test_chunks_cover_every_row():
    batch = pa.RecordBatch.from_pydict({"n": list(range(10))})
    for widths in ([trees.CHUNK] * 10, [1] * 10, [0] * 10, [trees.CHUNK * 3, *[0] * 9]):
        parts = list(trees.chunks([batch], lambda b, w=widths: np.array(w[: b.num_rows])))
        assert [x for p in parts for x in p.column("n").to_pylist()] == list(range(10))


def test_other_labels_and_settings_are_errors(spark):
    df = vectors(spark, 20)
    with pytest.raises(ValueError):
        models.estimator("dt").fit(df.withColumn("label", F.lit(2.0)))
    with pytest.raises(ValueError):
        models.estimator("dt").fit(df.where("doc_id < 0"))
    with pytest.raises(ValueError):
        models.estimator("dt", impurity="entropy").fit(df)


def test_counts_move_in_few_rows():
    rng = np.random.default_rng(3)
    code = np.unique(rng.integers(0, 5000, 4000))
    n0, n1 = (rng.integers(1, 9, len(code)).astype(np.int32) for _ in range(2))
    rows = list(trees.packed(code, n0, n1, bins=10, buckets=7))
    assert [b.num_rows for b in rows] == [7]
    # Two tasks with the same counts, sorted by bucket as after the shuffle.
    both = pa.Table.from_batches(rows * 2).sort_by("bucket").combine_chunks().to_batches(max_chunksize=3)
    parts = list(trees.whole_buckets(both))
    found, zeros, ones = trees.added(*(np.concatenate(c) for c in zip(*parts)))
    assert (found == code).all() and (zeros == 2 * n0).all() and (ones == 2 * n1).all()
    assert list(trees.packed(code[:0], n0[:0], n1[:0], 10, 7))[0].num_rows == 0
    assert list(trees.whole_buckets([])) == []


def test_shared_fits_count_values_once(spark, monkeypatch):
    df = vectors(spark, 60)
    made, counts = [], trees.value_counts
    monkeypatch.setattr(trees, "value_counts", lambda *a: made.append(1) or counts(*a))
    dt = models.estimator("dt").sharing()
    for bins in (4, 12):
        dt.fit(df, {dt.maxBins: bins, dt.maxDepth: 3})
    assert len(made) == 1
