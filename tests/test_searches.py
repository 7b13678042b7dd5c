"""Searches and matrices from additive counts, and the features and metrics under them."""

import math
import random

import numpy as np
import pytest
from helpers import by_doc
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF
from pyspark.sql import functions as F

from opinia.operators import bayes, evaluate, models, sparse, terms
from opinia.operators.order import running_sums
from opinia.plans import catalogue, select

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    rows = []
    for i in range(150):
        liked = i % 2
        said = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 12))]
        said += [rng.choice(["great", "tasty"] if liked else ["awful", "bland"])] * (rng.random() < 0.7)
        rows.append((i, float(liked), said))
    return spark.createDataFrame(rows, "doc_id long, label double, words array<string>").cache()


def brute_nb(train, test, smoothing):
    """{doc_id: score} of multinomial naive Bayes."""
    counts = [{}, {}]
    for label, words in train:
        for w in words:
            counts[int(label)][w] = counts[int(label)].get(w, 0) + 1
    vocab = set(counts[0]) | set(counts[1])
    totals = [sum(c.values()) + smoothing * len(vocab) for c in counts]
    n1 = sum(label == 1 for label, _ in train)
    prior = math.log(n1 / (len(train) - n1))
    out = {}
    for doc_id, words in test:
        out[doc_id] = prior + sum(
            math.log((counts[1].get(w, 0) + smoothing) / totals[1]) - math.log((counts[0].get(w, 0) + smoothing) / totals[0])
            for w in words if w in vocab
        )
    return out


def test_every_fold_is_scored_by_the_others(labelled):
    fold = models.hash_bucket("doc_id", 5, 3)
    rows = labelled.withColumn("fold", fold).collect()
    found = bayes.fold_scores(labelled, fold, range(3), [0.3, 1.0]).collect()
    assert len(found) == 2 * len(rows)
    for f in range(3):
        train = [(r["label"], r["words"]) for r in rows if r["fold"] != f]
        test = [(r["doc_id"], r["words"]) for r in rows if r["fold"] == f]
        for s in (0.3, 1.0):
            own = {r["doc_id"]: r["score"] for r in found if r["fold"] == f and r["smoothing"] == s}
            assert own == pytest.approx(brute_nb(train, test, s), abs=2e-6)


def test_folds_with_one_class_only(spark):
    rows = [(i, float(i % 2), ["a", "b"][: i % 3]) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, label double, words array<string>")
    # Fold 1 has liked documents only: it has no AUC, but an accuracy.
    fold = (F.col("label") == 1) & (F.col("doc_id") < 4)
    scores = bayes.fold_scores(df, fold.cast("int"), [1, 7])
    found = select.group_metrics(scores, ["smoothing", "fold"], "t").collect()
    assert len(found) == 4 * 2
    assert {r["value"] for r in found if r["fold"] == 1 and r["metric"] == "auc"} == {None}
    assert all(0 <= r["value"] <= 1 for r in found if r["metric"] == "accuracy")
    with pytest.raises(ValueError):
        bayes.fold_scores(df, (F.col("label") == 1).cast("int"), [0])


def test_search_counts_each_fold_and_the_mean(labelled):
    found = select.tune_nb(labelled, how="cv", folds=4).collect()
    assert len(found) == 4 * 2 * 5
    by_point = {}
    for r in found:
        if r["metric"] == "auc":
            by_point.setdefault(r["params"], {})[r["fold"]] = r["value"]
    assert all(v["mean"] == pytest.approx(np.mean([v[str(f)] for f in range(4)])) for v in by_point.values())
    best = max(sorted(by_point), key=lambda p: round(by_point[p]["mean"], 9))
    assert {r["params"] for r in found if r["is_best"]} == {best}
    with pytest.raises(ValueError):
        select.tune_nb(labelled, how="other")


def test_text_is_read_once(spark, monkeypatch):
    """All searches and strategies stand on one stored table, and only its plan has the text."""
    plans = []
    for module in (bayes, select, evaluate, sparse):
        if hasattr(module, "materialize"):
            store = module.materialize
            monkeypatch.setattr(
                module, "materialize",
                lambda df, *a, store=store, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or store(df, *a, **k),
            )
    for name in ("tune_nb_cv", "experiment_matrix_nb"):
        plans.clear()
        catalogue.QUERIES[name](spark, FOLDER)
        scans = sum(p.count("ReadSchema: struct<doc_id:bigint,text:string>") for p in plans)
        assert scans == 1, name


def test_strategies_are_scored_apart(labelled):
    part = models.split_column()
    dropped = {"all": [], "no great": ["GREAT", "awful"]}
    found = bayes.strategy_scores(labelled, part, dropped).collect()
    rows = labelled.withColumn("part", part).collect()
    for strategy, stop in dropped.items():
        stop = {w.lower() for w in stop}
        left = lambda words: [w for w in words if w not in stop]  # noqa: B023, E731
        train = [(r["label"], left(r["words"])) for r in rows if r["part"] == "train"]
        expected = brute_nb(train, [(r["doc_id"], left(r["words"])) for r in rows], 1.0)
        assert {r["doc_id"]: r["score"] for r in found if r["strategy"] == strategy} == pytest.approx(expected, abs=2e-6)


def test_running_sums_by_group(spark):
    rng = random.Random(2)
    groups = ["a"] * 500 + ["b", None, "c", "c"] + [None] * 30 + [f"g{i}" for i in range(40)]
    rows = [(g, i, rng.randint(0, 5)) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "g string, at int, x long")
    found = running_sums(df, [F.asc("at")], {"x": "before"}, "t", ["g"]).collect()
    so_far, expected = {}, {}
    for g, i, x in rows:
        expected[i] = so_far.get(g, 0)
        so_far[g] = so_far.get(g, 0) + x
    assert {r["at"]: r["before"] for r in found} == expected


def test_auc_by_group_equals_auc_alone(spark):
    rng = random.Random(9)
    rows = [(rng.choice("xyz"), float(rng.random() < 0.4), round(rng.gauss(0, 1), 1)) for _ in range(600)] + [("one", 1.0, 0.5)]
    df = spark.createDataFrame(rows, "g string, label double, score double")
    found = {r["g"]: r["auc"] for r in evaluate.auc(df, group=["g"]).collect()}
    assert found.pop("one") is None
    for g, value in found.items():
        assert value == pytest.approx(evaluate.auc(df.where(F.col("g") == g)).first()["auc"], rel=1e-12)


@pytest.mark.parametrize("bins", [1, 7, 1000])
def test_binned_auc_encloses_the_exact_one(spark, bins):
    rng = random.Random(bins)
    rows = [(float(rng.random() < 0.4), rng.gauss(0, 3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double")
    exact = evaluate.auc(df).first()["auc"]
    found = evaluate.auc_bounds(evaluate.histogram(df, -5, 5, bins)).first()
    assert found["auc_low"] <= exact <= found["auc_high"]
    assert bins < 1000 or found["auc_high"] - found["auc_low"] < 0.02
    # Histograms of parts add up to that of the whole.
    halves = [evaluate.histogram(df.where(c), -5, 5, bins) for c in ("score < 0", "score >= 0")]
    added = halves[0].unionByName(halves[1]).groupBy("bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    assert tuple(evaluate.auc_bounds(added).first()) == pytest.approx(tuple(found))
    assert evaluate.auc_bounds(evaluate.histogram(df.where("label = 1"), -5, 5, bins)).first()["auc_low"] is None


def vectors_of(df, column="features"):
    return {r["doc_id"]: r[column] for r in df.collect()}


def test_hashed_counts_equal_the_ml_stages(labelled):
    """At 16 columns most tokens collide; they are added before documents are counted."""
    parts = bayes.stored_terms(labelled, [models.split_column().alias("part")])
    buckets = sparse.token_buckets(sparse.token_stats(parts), 16)
    counts = sparse.hashed_counts(parts, buckets, ["doc_id", "part"], {"sw_none": []})
    train, _ = models.split_train_test(labelled)
    found = sparse.weighted(counts, "part = 'train'", train.count(), ["strategy"], "bucket").collect()
    tf = HashingTF(inputCol="words", outputCol="raw", numFeatures=16)
    fitted = IDF(inputCol="raw", outputCol="features").fit(tf.transform(train))
    expected = vectors_of(fitted.transform(tf.transform(labelled)))
    own = {d: np.zeros(16) for d in expected}
    for r in found:
        own[r["doc_id"]][r["bucket"]] = r["tf_idf"]
    for d, vector in expected.items():
        assert own[d] == pytest.approx(vector.toArray())


def test_count_vectors_equal_the_ml_stages(labelled):
    parts = bayes.stored_terms(labelled, [models.split_column().alias("part")])
    vocab = sparse.train_vocabulary(sparse.token_stats(parts, "part = 'train'"), 1 << 18)
    train, _ = models.split_train_test(labelled)
    listed = [r["token"] for r in vocab.orderBy("index").collect()]
    assert set(listed) == {w for ws in by_doc(train, "words").values() for w in ws}
    counts = sparse.vocabulary_counts(parts, vocab, ["doc_id"])
    entries = counts.withColumn("v", F.col("tf") * terms.idf_column(F.col("df"), train.count()))
    found = sparse.stored_vectors(parts.drop("terms"), entries, len(listed), "v", "index", 3)
    counter = CountVectorizerModel.from_vocabulary(listed, "words", "raw")
    fitted = IDF(inputCol="raw", outputCol="features").fit(counter.transform(train))
    expected = vectors_of(fitted.transform(counter.transform(labelled)))
    own = vectors_of(found)
    assert own.keys() == expected.keys()
    for d, vector in expected.items():
        assert own[d].size == vector.size and own[d].toArray() == pytest.approx(vector.toArray())
    assert found.rdd.getNumPartitions() <= 3 and models.estimator("lr", maxIter=5).fit(found).numFeatures == len(listed)


def folded(labelled, width=64):
    fold = models.hash_bucket("doc_id", models.SEED, 3).cast("int").alias("fold")
    docs = bayes.stored_terms(labelled, [fold])
    buckets = sparse.token_buckets(sparse.token_stats(docs), width)
    counts = sparse.hashed_counts(docs, buckets, ["doc_id", "fold"], {"sw_none": []})
    return docs.drop("terms"), counts


def test_validation_documents_do_not_move_the_idf(labelled):
    """Whatever the documents of a fold say, its own row of frequencies stays, and the others change."""
    fold = models.hash_bucket("doc_id", models.SEED, 3)
    changed = labelled.withColumn("words", F.when(fold == 1, F.array(F.lit("w1"), F.lit("entirely"), F.lit("other"))).otherwise(F.col("words")))
    before, after = (
        {f: {(r["bucket"], r["df"]) for r in rows if r["fold"] == f} for f in range(3)}
        for rows in (sparse.leave_out_df(folded(df)[1], 3).collect() for df in (labelled, changed))
    )
    assert before[1] == after[1] and before[0] != after[0] and before[2] != after[2]


def test_refitted_search_equals_a_pipeline_in_each_fold(labelled):
    docs, counts = folded(labelled)
    vectors = sparse.stored_vectors(docs, counts, 64, "tf", "bucket")
    lr = models.estimator("lr")
    points = select.param_grid(lr)[:2]
    found = select.tune_refit(vectors, sparse.leave_out_df(counts, 3), lr, 3, 64, points).collect()
    assert len(found) == 2 * 3 + 2 and sum(r["is_best"] for r in found) == 4
    plain = vectors.drop("fold").withColumnRenamed("features", "rawFeatures")
    pipeline = Pipeline(stages=[IDF(inputCol="rawFeatures", outputCol="features"), lr])
    rows, best = select.tune(plain, pipeline, points, how="cv", folds=3)
    expected = {r["params"]: r["value"] for r in rows.collect()}
    assert {r["params"]: r["value"] for r in found if r["fold"] == "mean"} == pytest.approx(expected, abs=1e-6)
    assert best.stages[-1].numFeatures == 64


def test_stopped_search_goes_on_where_it_was(labelled, tmp_path, monkeypatch):
    docs, counts = folded(labelled)
    vectors = sparse.stored_vectors(docs, counts, 64, "tf", "bucket").drop("fold")
    fitted = []
    kind = type(models.estimator("dt"))
    fit = kind.fit

    def counted(self, df, params=None):
        if len(fitted) == 2 and not resumed:
            raise RuntimeError("stopped")
        fitted.append(select.describe(params))
        return fit(self, df, params)

    monkeypatch.setattr(kind, "fit", counted)
    dt = models.estimator("dt")
    points = select.param_grid(dt)
    settings = {"points": points, "store": str(tmp_path), "parallelism": 1}
    resumed = False
    with pytest.raises(RuntimeError):
        select.tune_resumed(vectors, dt, **settings)
    resumed = True
    rows = select.tune_resumed(vectors, dt, **settings).collect()
    assert sorted(fitted) == sorted(map(select.describe, points)) and len(rows) == 6
    again = select.tune_resumed(vectors.repartition(3), dt, **settings).collect()
    assert again == rows and len(fitted) == 6 and sum(r["is_best"] for r in rows) == 1
    # Other data are another search.
    select.tune_resumed(vectors.where("doc_id <> 3"), dt, **(settings | {"points": points[:1]}))
    assert len(fitted) == 7


def test_weights_of_all_buckets_move_no_counts(spark, capsys):
    # One row a bucket, more buckets than other lookups may have rows.
    n = 220_000
    counts = spark.range(n).selectExpr("id AS doc_id", "'a' AS strategy", "CAST(id AS int) AS bucket", "2L AS tf")
    found = sparse.weighted(counts, "doc_id < 10", 10, ["strategy"], "bucket")
    found.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    some = {r["bucket"]: r["tf_idf"] for r in found.where("bucket in (3, 219999)").collect()}
    assert found.count() == n
    assert some == pytest.approx({3: 2 * math.log(11 / 2), 219999: 2 * math.log(11)})
