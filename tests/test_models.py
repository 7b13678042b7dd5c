import math
import random

import pytest
from helpers import by_doc
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from opinia.operators import evaluate, insight, models, terms
from opinia.operators.features import STRATEGIES, build_pipeline
from opinia.plans import select
from opinia.session import materialize
from opinia.sources import reviews as sources

PREDICTIONS = [
    (1, 1.0, 0.9, 1.0), (2, 0.0, 0.8, 1.0), (3, 1.0, 0.7, 1.0),
    (4, 0.0, 0.3, 0.0), (5, 1.0, 0.3, 0.0), (6, 0.0, 0.1, 0.0),
]


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(PREDICTIONS, "doc_id long, label double, score double, prediction double")


@pytest.fixture(scope="module")
def learnable(spark):
    """Liked texts say great, disliked ones say awful; the rest is noise."""
    rng = random.Random(3)
    noise = ["the", "food", "was", "pizza", "service", "red", "holiday", "and"]
    rows = []
    for i in range(120):
        liked = i % 2
        said = [rng.choice(noise) for _ in range(5)] + [rng.choice(["great", "tasty"] if liked else ["awful", "bland"])]
        rng.shuffle(said)
        rows.append((i, " ".join(said), float(liked)))
    return spark.createDataFrame(rows, "doc_id long, text string, label double").cache()


def with_words(df):
    return df.select("doc_id", "label", F.split("text", " ").alias("words"))


def test_accuracy_and_confusion(predictions):
    row = evaluate.accuracy(predictions).first()
    assert row["n"] == 6 and math.isclose(row["accuracy"], 4 / 6) and not row["invert"]
    wrong = predictions.withColumn("prediction", 1 - F.col("label"))
    assert evaluate.accuracy(wrong).first()["invert"] and evaluate.accuracy(wrong).first()["complement"] == 1.0
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(predictions).collect()}
    assert cells == {(1.0, 1.0): 2, (0.0, 1.0): 1, (1.0, 0.0): 1, (0.0, 0.0): 2}


def test_auc(predictions):
    assert math.isclose(evaluate.auc(predictions).first()["auc"], 6.5 / 9)
    one_class = predictions.where("label = 1")
    assert tuple(evaluate.auc(one_class).first()) == (3, 0, None)


def test_auc_equals_the_ml_evaluator(spark):
    rng = random.Random(5)
    rows = [(float(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double")
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert math.isclose(evaluate.auc(df.repartition(7)).first()["auc"], expected, rel_tol=1e-9)


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    train, test = models.split_train_test(df)
    assert train.count() + test.count() == 1000 and 750 < train.count() < 850
    again, _ = models.split_train_test(df.repartition(7))
    assert {r["doc_id"] for r in train.collect()} == {r["doc_id"] for r in again.collect()}
    other, _ = models.split_train_test(df, seed=1)
    assert {r["doc_id"] for r in train.collect()} != {r["doc_id"] for r in other.collect()}


def test_naive_bayes_equals_the_ml_model(learnable):
    df = with_words(learnable)
    train, test = models.split_train_test(df)
    weights, prior = models.nb_train(train)
    found = models.nb_score(test, weights, prior)
    vocabulary = sorted({t for ws in by_doc(train, "words").values() for t in ws})
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "words", "features")
    ml = NaiveBayes(smoothing=1.0).fit(counter.transform(train)).transform(counter.transform(test))
    # The ML model also smooths the class prior; the classes are near even, so it hardly counts.
    expected = by_doc(ml, "prediction")
    assert by_doc(found, "prediction") == expected
    assert evaluate.accuracy(found).first()["accuracy"] == 1.0


def test_naive_bayes_without_known_terms(spark, learnable):
    weights, prior = models.nb_train(with_words(learnable).where("doc_id < 90 or label = 1"))
    other = spark.createDataFrame(
        [(1, 1.0, ["unseen"]), (2, 0.0, [])], "doc_id long, label double, words array<string>"
    )
    scores = set(by_doc(models.nb_score(other, weights, prior), "score").values())
    assert scores == {round(math.log(60 / 45), 6)}
    with pytest.raises(ValueError):
        models.nb_train(with_words(learnable).where("label = 1"))


def test_buzzwords_and_association(learnable):
    counts = materialize(insight.class_counts(with_words(learnable)), "counts")
    best = {(r["class"], r["token"]) for r in insight.buzzwords(counts, k=2).collect()}
    assert best == {(1, "great"), (1, "tasty"), (0, "awful"), (0, "bland")}
    rows = {r["token"]: r for r in insight.term_label_association(counts, 60, 60).collect()}
    assert rows["great"]["chi2"] > 10 > rows["pizza"]["chi2"]
    assert math.isclose(rows["great"]["pmi"], math.log(2)) and rows["awful"]["pmi"] is None


def test_chi_square_equals_the_ml_test(learnable):
    from pyspark.ml.stat import ChiSquareTest

    df = with_words(learnable)
    marks = CountVectorizerModel.from_vocabulary(["great", "pizza"], "words", "features").setBinary(True)
    ml = ChiSquareTest.test(marks.transform(df), "features", "label").first()
    rows = insight.term_label_association(insight.class_counts(df), 60, 60)
    found = {r["token"]: r["chi2"] for r in rows.collect()}
    assert math.isclose(found["great"], ml["statistics"][0]) and math.isclose(found["pizza"], ml["statistics"][1])


@pytest.mark.parametrize("name", ["lr", "dt", "nb", "rf", "svc"])
def test_every_classifier_learns(learnable, name):
    train, test = models.split_train_test(learnable)
    # A forest of the default size finds the four words that matter among the twelve that there are.
    columns = {"vectorizer": "count"} if name == "rf" else {"num_features": 512}
    pipeline = build_pipeline("sw_none", models.estimator(name), spelling="none", **columns)
    scored = pipeline.fit(train).transform(test)
    scored = scored.withColumn("score", models.score_column(scored))
    assert evaluate.accuracy(scored).first()["accuracy"] > 0.9
    assert evaluate.auc(scored).first()["auc"] > 0.9
    if "probability" in scored.columns:
        total = F.aggregate(models.vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
        assert all(abs(r["t"] - 1) < 1e-9 for r in scored.select(total.alias("t")).collect())


def test_strategies_differ_and_share_no_stage(learnable):
    pipelines = {s: build_pipeline(s, spelling="none", vectorizer="count") for s in STRATEGIES}
    stages = [st for p in pipelines.values() for st in p.getStages()]
    assert len({id(s) for s in stages}) == len(stages)
    vocabularies = {s: frozenset(p.fit(learnable).stages[-2].vocabulary) for s, p in pipelines.items()}
    assert len(set(vocabularies.values())) == 3
    assert "the" not in vocabularies["sw_pre"] and "the" in vocabularies["sw_none"]
    assert "holiday" not in vocabularies["sw_cstm"] and "holiday" in vocabularies["sw_pre"]
    with pytest.raises(ValueError):
        build_pipeline("sw_other")
    with pytest.raises(ValueError):
        build_pipeline("sw_none", vectorizer="embeddings")


def test_strategy_stats(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, [])], "doc_id long, words array<string>")
    found = insight.strategy_stats(terms.term_stats(df), 2, {"x": [], "y": ["A"]})
    rows = {r["strategy"]: tuple(r) for r in found.collect()}
    assert rows == {"x": ("x", 2, 3, 2), "y": ("y", 2, 1, 1)}


def test_grids():
    lr = select.param_grid(models.estimator("lr"))
    assert len(lr) == 8 and "maxIter=25,regParam=0.01" in {select.describe(p) for p in lr}
    dt = {select.describe(p) for p in select.param_grid(models.estimator("dt"))}
    assert dt == {f"maxBins={b},maxDepth={d}" for b in (10, 50, 100) for d in (10, 30)}
    assert select.param_grid(models.estimator("nb")) == [{}]
    with pytest.raises(ValueError):
        models.estimator("other")


@pytest.mark.parametrize("how", ["tvs", "cv"])
def test_tuning_does_not_depend_on_layout(learnable, how):
    pipeline = build_pipeline("sw_none", spelling="none", num_features=256)
    features = pipeline.fit(learnable).transform(learnable).select("doc_id", "label", "features")
    lr = models.estimator("lr")
    points = select.param_grid(lr)[:2]
    rows, model = select.tune(features, lr, points, how=how, folds=2)
    again, _ = select.tune(features.repartition(5), lr, points, how=how, folds=2)
    values = [r["value"] for r in rows.collect()]
    assert values == pytest.approx([r["value"] for r in again.collect()], abs=1e-9)
    assert [r["params"] for r in rows.collect()] == [select.describe(p) for p in points]
    assert sum(r["is_best"] for r in rows.collect()) == 1 and max(values) > 0.9
    assert model.numFeatures == 256
    with pytest.raises(ValueError):
        select.tune(features, lr, points, how="other")


def test_experiment_matrix(spark, learnable):
    train, test = models.split_train_test(learnable)
    found = select.experiment_matrix(train, test, models={"lr": {"maxIter": 5}, "dt": {}}, num_features=256)
    rows = found.collect()
    assert {(r["pipeline"], r["model"], r["metric"]) for r in rows} == {
        (s, m, k) for s in STRATEGIES for m in ("lr", "dt") for k in ("auc_train", "auc_test")
    }
    assert all(r["value"] > 0.7 for r in rows)
    searched = select.experiment_matrix(
        train, test, strategies=["sw_none"], models={"lr": {}}, spelling="none", num_features=64, search="tvs"
    )
    assert all(r["params"].startswith("maxIter=") for r in searched.collect())


def test_results_are_kept(spark, tmp_path):
    frame = sources.results_frame(spark, [("sw_none", "lr", "", "auc_test", 0.5)])
    sources.write_results(frame, str(tmp_path / "results"))
    sources.write_results(frame, str(tmp_path / "results"))
    kept = spark.read.parquet(str(tmp_path / "results"))
    assert kept.count() == 2
    assert sources.report_lines(kept).first()["line"] == "sw_none - lr: auc_test=0.500000"


def test_coefficients_name_the_terms(learnable):
    pipeline = build_pipeline("sw_none", models.estimator("lr"), spelling="none", vectorizer="count")
    fitted = pipeline.fit(learnable)
    weights = dict(zip(fitted.stages[-3].vocabulary, fitted.stages[-1].coefficients))
    assert weights["great"] > 0 > weights["awful"]
    assert set(terms.term_stats(with_words(learnable)).toPandas()["token"]) == set(weights)
