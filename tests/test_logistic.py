import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from opinia.operators import logistic, models
from opinia.plans import select
from opinia.session import materialize

WIDTH = 50


@pytest.fixture(scope="module")
def vectors(spark):
    """Counts of three sizes, a feature that is a constant, one that only fold 1 has, and empty documents but for them."""
    draw = np.random.default_rng(7)
    rows = []
    for i in range(400):
        index = draw.choice(38, draw.integers(0, 12), replace=False)
        counts = draw.poisson(1.5, len(index)) * draw.choice([1.0, 0.37, 20.0], len(index))
        found = {int(a): float(b) for a, b in zip(index, counts) if b} | {38: 0.1}
        if i % 3 == 1:
            found[39] = 1.0 + i % 5
        rows.append((i, i % 3, float(draw.random() < 0.2 + 0.5 * (3 in found)), Vectors.sparse(WIDTH, found)))
    frame = spark.createDataFrame(rows, ["doc_id", "fold", "label", "features"])
    return materialize(frame.selectExpr("doc_id", "CAST(fold AS int) AS fold", "label", "features"), "vectors")


@pytest.mark.parametrize("tol, points", [(1e-6, [(0.1, 1), (0.01, 25), (0.1, 10), (0.0, 60)]), (1e-2, [(0.1, 100)]), (0.3, [(0.01, 100)])])
def test_paths_equal_the_fits_of_spark_ml(vectors, tol, points):
    """Also where a path ends before its number of iterations."""
    lr = LogisticRegression(tol=tol)
    grid = [{lr.regParam: penalty, lr.maxIter: most} for penalty, most in points]
    scores = logistic.search(vectors, lr, grid, logistic.class_sizes(vectors, range(3)), WIDTH)
    for f, found in scores.items():
        inside, outside = vectors.where(f"fold <> {f}"), vectors.where(f"fold = {f}")
        for i, point in enumerate(grid):
            expected = lr.fit(inside, point).transform(outside).select("rawPrediction").collect()
            got = [r[0] for r in found.select(f"m{i}").collect()]
            assert sorted(got) == pytest.approx(sorted(r[0][1] for r in expected), abs=1e-9)


def test_points_and_folds_share_their_passes(vectors, monkeypatch):
    passes = []
    losses = logistic.losses
    monkeypatch.setattr(logistic, "losses", lambda *args: passes.append(1) or losses(*args))
    counts = vectors.sparkSession.createDataFrame([(f, 3, 5) for f in range(3)], "fold int, bucket int, df long")
    found = select.tune_refit(vectors, counts, models.estimator("lr"), 3, WIDTH).collect()
    # 8 points in 3 folds ask for 25 iterations at most.
    assert 1 < len(passes) <= 40 and len(found) == 8 * 3 + 8


def test_weights_without_a_document_count_as_nothing(vectors):
    """A weight of zero takes a feature out; any other is undone by the scaling, as Spark ML's is."""
    lr = models.estimator("lr")
    grid = [{lr.regParam: 0.1, lr.maxIter: 10}]
    weights = np.r_[np.full(20, 2.5), np.zeros(WIDTH - 20)]
    sizes = logistic.class_sizes(vectors, [0])
    found = logistic.search(vectors, lr, grid, sizes, WIDTH, lambda f: weights)[0]
    weighted = select.scaled(vectors, weights)
    fitted = lr.fit(weighted.where("fold <> 0"), grid[0])
    expected = [r[0][1] for r in fitted.transform(weighted.where("fold = 0")).select("rawPrediction").collect()]
    assert sorted(r["m0"] for r in found.collect()) == pytest.approx(sorted(expected), abs=1e-9)


def test_other_learners_and_parts_are_left_to_spark_ml(vectors):
    lr = models.estimator("lr")
    assert logistic.shares(lr, select.param_grid(lr))
    assert not logistic.shares(lr, [{lr.elasticNetParam: 0.5}])
    assert not logistic.shares(models.estimator("lr", fitIntercept=False), select.param_grid(lr))
    assert not logistic.shares(models.estimator("svc"), [{}])
    assert logistic.class_sizes(vectors, range(4)) is None
    assert logistic.class_sizes(vectors.where("fold = 1 OR label = 1"), range(2)) is None
    # One class to learn from: Spark ML's answer, as before.
    rows, _ = select.tune(vectors.drop("fold").where("label = 1"), lr, select.param_grid(lr)[:1], how="tvs")
    assert [r["value"] for r in rows.collect()] == [1.0]


@pytest.mark.parametrize("values, kind", [([1.0, 255.0], "u1"), ([0.5, 256.0], "f4"), ([-1.0, 3.0], "f4"), ([0.1], "f8"), ([1e300], "f8"), ([], "u1")])
def test_values_are_stored_short_but_exactly(values, kind):
    found, short = logistic.narrowed(np.array(values, dtype=float))
    assert found == kind and short.astype(float).tolist() == values
