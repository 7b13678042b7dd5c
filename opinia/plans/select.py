"""Model selection: parameter grids, validated search, and the strategy x model matrix."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.operators import logistic
from opinia.operators.bayes import SMOOTHING, fold_scores, strategy_scores
from opinia.operators.evaluate import accuracy, auc
from opinia.operators.features import STRATEGIES, cleaning_stages, vector_stages
from opinia.operators.models import SEED, estimator, hash_bucket, split_column
from opinia.operators.sparse import scaled
from opinia.operators.trees import SparseDecisionTree
from opinia.session import exists, materialize, scratch_dir
from opinia.sources.reviews import RESULT_SCHEMA, results_frame, write_results

# The grids. The deepest tree that Spark ML accepts has depth 30, which stands
# for the larger depths of the grid.
LR_REG_PARAM = [0.1, 0.01]
LR_MAX_ITER = [1, 5, 10, 25]
DT_MAX_BINS = [10, 50, 100]
DT_MAX_DEPTH = [10, 50, 100]
DEEPEST_TREE = 30
USABLE_DEPTHS = [10, 30]


def param_grid(model) -> list[dict]:
    """The grid for a logistic regression or a decision tree; one empty point otherwise."""
    grid = ParamGridBuilder()
    if isinstance(model, LogisticRegression):
        grid = grid.addGrid(model.regParam, LR_REG_PARAM).addGrid(model.maxIter, LR_MAX_ITER)
    elif isinstance(model, DecisionTreeClassifier):
        grid = grid.addGrid(model.maxBins, DT_MAX_BINS).addGrid(model.maxDepth, USABLE_DEPTHS)
    return grid.build()


def describe(point: dict) -> str:
    """``maxIter=5,regParam=0.1``."""
    return ",".join(f"{k}={v}" for k, v in sorted((p.name, v) for p, v in point.items()))


def evaluator(num_bins: int = 0) -> BinaryClassificationEvaluator:
    """Area under ROC; ``num_bins=0`` is exact, a positive number bins the scores."""
    return BinaryClassificationEvaluator(numBins=num_bins)


def learner_partitions(spark) -> int:
    """Partitions of a learner's table: one for each shuffle partition of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def coefficients(spark, model) -> DataFrame:
    """``(index, coefficient)`` of a fitted linear model, stored; the model itself is on the driver."""
    values = model.coefficients.toArray()
    table = pa.table({"index": np.arange(len(values), dtype=np.int64), "coefficient": values})
    return materialize(spark.createDataFrame(table), "coefficients")


def margin_values(scores: dict[int, DataFrame], n_points: int, parallelism: int) -> dict[int, list[float]]:
    """The area under ROC of every point in each fold, from :func:`opinia.operators.logistic.search`."""
    jobs = [(f, i) for f in scores for i in range(n_points)]
    if not jobs:
        return {}
    spark = scores[jobs[0][0]].sparkSession

    def value(job):
        f, i = job
        return float(evaluator().setRawPredictionCol(f"m{i}").evaluate(scores[f].select("label", f"m{i}")))

    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        values = pool.map(inheritable_thread_target(spark)(value), jobs, chunksize=1)
    return {f: [v for (g, _), v in zip(jobs, values) if g == f] for f in scores}


def tune_refit(
    vectors: DataFrame,
    fold_df: DataFrame,
    model,
    folds: int,
    num_features: int,
    points: Sequence[dict] | None = None,
    index: str = "bucket",
    parallelism: int = 4,
) -> DataFrame:
    """Cross-validate ``points`` with an IDF that is refitted in every fold: ``(params, fold, metric, value,
    is_best)``, a row for each point and fold, and the means as fold 'mean'.

    ``vectors (doc_id, label, fold, features)`` hold plain term counts, ``fold_df (fold, bucket, df)`` the
    document frequencies without each fold (:func:`opinia.operators.sparse.leave_out_df`). A
    fold's weights come from its own rows of that table, so neither the text nor the vectors are
    read again to fit them, and its documents have no part in them. The driver holds one array
    of ``num_features`` numbers for each fold. A logistic regression's points and folds are fitted
    together (:mod:`opinia.operators.logistic`).
    """
    spark = vectors.sparkSession
    points = list(points or param_grid(model))
    sizes = {r["fold"]: r["n"] for r in vectors.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    found = fold_df.select("fold", index, "df").toArrow()
    of_fold, at, counted = (found.column(c).to_numpy() for c in ("fold", index, "df"))

    def weights(f: int) -> np.ndarray:
        df = np.zeros(num_features)
        df[at[of_fold == f]] = counted[of_fold == f]
        n_docs = sum(n for g, n in sizes.items() if g != f)
        return np.log((n_docs + 1) / (df + 1))

    parts = logistic.class_sizes(vectors, range(folds)) if logistic.shares(model, points) else None
    if parts:
        scores = logistic.search(vectors, model, points, parts, num_features, weights)
        by_fold = margin_values(scores, len(points), parallelism)
        values = [(i, f, v) for f, own in by_fold.items() for i, v in enumerate(own)]
    else:
        score = evaluator()
        jobs = []
        for f in range(folds):
            weighted = scaled(vectors, weights(f))
            fits = model.fitMultiple(weighted.where(F.col("fold") != f), points)
            jobs += [(f, fits, weighted.where(F.col("fold") == f))] * len(points)

        def next_value(job):
            f, fits, check_on = job
            at, fitted = next(fits)
            return at, f, float(score.evaluate(fitted.transform(check_on)))

        with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
            values = pool.map(inheritable_thread_target(spark)(next_value), jobs, chunksize=1)
    means = [float(np.mean([v for at, _, v in values if at == i])) for i in range(len(points))]
    best = means.index(max(means))
    rows = [(describe(points[at]), str(f), "auc", v, at == best) for at, f, v in sorted(values)]
    rows += [(describe(p), "mean", "auc", means[i], i == best) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "params string, fold string, metric string, value double, is_best boolean")


def tune(
    features: DataFrame,
    model,
    points: Sequence[dict] | None = None,
    how: str = "tvs",
    folds: int = 3,
    train_percent: int = 75,
    seed: int = SEED,
    parallelism: int = 4,
    key: str = "doc_id",
):
    """Search ``points`` on ``(doc_id, label, features)``; returns ``(rows, best fitted model)``.

    ``model`` may be a :class:`Pipeline`, with the points of its last stage; then ``features`` is the
    table that its first stage reads, and all its stages are fitted inside each part or fold.
    ``rows`` is ``(params, value, is_best)``. ``how='tvs'`` scores once on a held-out part,
    ``how='cv'`` averages over folds. Parts and folds follow the document id, so the search
    does not depend on the data layout. Ties go to the earlier point.
    """
    points = list(points or param_grid(model.getStages()[-1] if isinstance(model, Pipeline) else model))
    for point in points:
        for param, value in point.items():
            if param.name == "maxDepth" and value > DEEPEST_TREE:
                raise ValueError(f"depth {value}: Spark ML grows trees to depth {DEEPEST_TREE}")
    score = evaluator()
    if how == "cv":
        folded = features.withColumn("fold", hash_bucket(key, seed, folds).cast("int"))
        search = CrossValidator(
            estimator=model,
            estimatorParamMaps=points,
            evaluator=score,
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(materialize(folded, "folds"))
        values, best_model = list(search.avgMetrics), search.bestModel
    elif how == "tvs":
        marked = materialize(features.withColumn("part", split_column(key, train_percent, seed)), "parts")
        fit_on = marked.where(F.col("part") == "train")
        check_on = marked.where(F.col("part") == "test")
        fits = model.fitMultiple(fit_on, points)

        def next_value(_):
            index, fitted = next(fits)
            return index, score.evaluate(fitted.transform(check_on))

        with ThreadPool(max(1, min(parallelism, len(points)))) as pool:
            found = pool.map(inheritable_thread_target(features.sparkSession)(next_value), points)
        values = [value for _, value in sorted(found)]
        best_model = model.fit(marked, points[values.index(max(values))])
    else:
        raise ValueError(f"unknown search {how!r}; known: tvs, cv")
    best = values.index(max(values))
    rows = features.sparkSession.createDataFrame(
        [(describe(p), float(v), i == best) for i, (p, v) in enumerate(zip(points, values))],
        "params string, value double, is_best boolean",
    )
    return rows, best_model


def search_key(features: DataFrame, model, train_percent: int, seed: int, key: str) -> str:
    """What a search's results depend on besides the points: the rows, the model's own settings, the split."""
    mark = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*features.columns)).alias("x"))
    rows = features.agg(mark.alias("m")).first()["m"]
    own = sorted((p.name, str(v)) for p, v in model.extractParamMap().items())
    told = repr((type(model).__name__, own, tuple(rows), features.columns, train_percent, seed, key))
    return hashlib.md5(told.encode()).hexdigest()


def tune_resumed(
    features: DataFrame,
    model,
    points: Sequence[dict] | None = None,
    train_percent: int = 75,
    seed: int = SEED,
    key: str = "doc_id",
    store: str | None = None,
    parallelism: int = 3,
) -> DataFrame:
    """Search ``points`` on a held-out part, as :func:`tune` does, a point at a time: ``(params, value, is_best)``.

    Every point that is finished goes to the result store, the folder ``store`` (by default in the
    session's shared folder), under a key of the data and the parameters. A search that was
    stopped, on this or another driver, fits only what is missing when it is run again; other
    data, another split or other settings have another key.
    """
    spark = features.sparkSession
    points = list(points or param_grid(model))
    marked = materialize(features.withColumn("part", split_column(key, train_percent, seed)), "parts")
    fit_on, check_on = (marked.where(F.col("part") == part).drop("part") for part in ("train", "test"))
    run = search_key(marked, model, train_percent, seed, key)
    base = f"{(store or f'{scratch_dir(spark)}/opinia/results').rstrip('/')}/{run}"
    # A folder for each point, so that points can be written at the same time.
    place = {describe(p): f"{base}/{hashlib.md5(describe(p).encode()).hexdigest()}" for p in points}
    known = {name: path for name, path in place.items() if exists(spark, f"{path}/_SUCCESS")}
    score = evaluator()
    # A deep tree holds the shallow ones.
    model = model.sharing() if isinstance(model, SparseDecisionTree) else model

    def finish(point: dict) -> None:
        name = describe(point)
        value = float(score.evaluate(model.fit(fit_on, point).transform(check_on)))
        row = results_frame(spark, [(run, type(model).__name__, name, "auc", value)])
        write_results(row.coalesce(1), place[name], mode="overwrite")

    missing = [p for p in points if describe(p) not in known]
    if missing:
        with ThreadPool(max(1, min(parallelism, len(missing)))) as pool:
            pool.map(inheritable_thread_target(spark)(finish), missing, chunksize=1)
    found = spark.read.schema(RESULT_SCHEMA).parquet(*place.values())
    value = {r["params"]: r["value"] for r in found.collect()}
    values = [value[describe(p)] for p in points]
    rows = [(describe(p), v, i == values.index(max(values))) for i, (p, v) in enumerate(zip(points, values))]
    return spark.createDataFrame(rows, "params string, value double, is_best boolean")


def group_metrics(predictions: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """``(*group, metric, value)``: ``auc`` and ``accuracy`` of every group, from one stored table."""
    stored = materialize(predictions.select(*group, "label", "score", "prediction"), name)
    areas = auc(stored, name=f"{name}-scores", group=group)
    hits = accuracy(stored, group)
    return areas.select(*group, F.lit("auc").alias("metric"), F.col("auc").alias("value")).unionByName(
        hits.select(*group, F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    )


def tune_nb(
    df: DataFrame,
    how: str = "cv",
    folds: int = 3,
    train_percent: int = 75,
    smoothing: Sequence[float] = SMOOTHING,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """Search the smoothing of naive Bayes on ``(doc_id, label, words)``: ``(params, fold, metric, value,
    is_best)``, a row for each smoothing value, fold and metric, and the means of all folds
    as fold 'mean'. ``how='tvs'`` has one fold, the held-out part.

    The best point has the largest mean AUC, of equal ones the least smoothing; without any AUC
    there is none.
    """
    if how == "cv":
        fold, held_out = hash_bucket(key, seed, folds), range(folds)
    elif how == "tvs":
        fold, held_out = (split_column(key, train_percent, seed) == "test").cast("int"), [1]
    else:
        raise ValueError(f"unknown search {how!r}; known: tvs, cv")
    scores = fold_scores(df, fold, held_out, smoothing)
    by_fold = materialize(group_metrics(scores, ["smoothing", "fold"], f"nb-{how}"), "fold-metrics")
    means = by_fold.groupBy("smoothing", "metric").agg(F.avg("value").alias("value"))
    every = by_fold.withColumn("fold", F.col("fold").cast("string")).unionByName(means.withColumn("fold", F.lit("mean")))
    # A row for each smoothing value.
    best = means.where("metric = 'auc'").agg(F.max(F.struct(F.round("value", 9), -F.col("smoothing")))).first()[0]
    chosen = F.lit(None if best is None or best[0] is None else -best[1]).cast("double")
    return every.select(
        F.concat(F.lit("smoothing="), F.col("smoothing").cast("string")).alias("params"),
        "fold",
        "metric",
        "value",
        F.coalesce(F.col("smoothing") == chosen, F.lit(False)).alias("is_best"),
    )


def experiment_matrix_nb(df: DataFrame, dropped: dict[str, list[str]], part: Column | None = None) -> DataFrame:
    """``(pipeline, model, params, metric, value)`` of naive Bayes under each strategy's stop words, on both
    parts of ``(doc_id, label, words)``: AUC and accuracy of all of them from one pass.
    A part without one of the classes has no AUC, which is null."""
    scores = strategy_scores(df, split_column() if part is None else part, dropped)
    found = group_metrics(scores, ["strategy", "part"], "nb-matrix")
    return found.select(
        F.col("strategy").alias("pipeline"),
        F.lit("nb").alias("model"),
        F.lit("").alias("params"),
        F.concat_ws("_", "metric", "part").alias("metric"),
        "value",
    )


def experiment_matrix(
    train: DataFrame,
    test: DataFrame,
    strategies: Sequence[str] = STRATEGIES,
    models: dict[str, dict] | None = None,
    spelling: str = "context",
    vectorizer: str = "hashing",
    num_features: int = 1 << 18,
    search: str | None = None,
    num_bins: int = 0,
    parallelism: int = 1,
) -> DataFrame:
    """``(pipeline, model, params, metric, value)`` for each strategy and model.

    ``models`` maps a model name to its parameters. Spelling and lemmas are learned from
    the training part and applied once for all strategies; features are fitted once per
    strategy and kept for all models on it; ``parallelism`` strategies run at a time, each of which
    holds coefficients of its learners on the driver. AUC is reported on both parts, under its name.
    """
    spark = train.sparkSession
    models = {"lr": {}, "dt": {}} if models is None else models
    clean_train, clean_test = clean_parts(train, test, spelling)
    score = evaluator(num_bins)

    def of_strategy(strategy: str) -> list[tuple]:
        fitted = Pipeline(stages=vector_stages(strategy, vectorizer, num_features)).fit(clean_train)
        parts = {
            part: materialize(fitted.transform(df).select("doc_id", "label", "rawFeatures", "features"), f"vectors-{part}")
            for part, df in (("train", clean_train), ("test", clean_test))
        }
        rows = []
        for name, params in models.items():
            model = estimator(name, **params)
            if search:
                # The IDF is fitted again on what each point learns from.
                refitted = Pipeline(stages=[IDF(inputCol="rawFeatures", outputCol="features"), model])
                found, best = tune(parts["train"].drop("features"), refitted, how=search)
                described = found.where("is_best").first()["params"]
            else:
                best = model.fit(parts["train"])
                described = ",".join(f"{k}={v}" for k, v in sorted(params.items()))
            for part, frame in parts.items():
                value = float(score.evaluate(best.transform(frame.drop("features") if search else frame)))
                rows.append((strategy, name, described, f"auc_{part}", value))
        return rows

    with ThreadPool(max(1, min(parallelism, len(strategies)))) as pool:
        rows = pool.map(inheritable_thread_target(spark)(of_strategy), list(strategies))
    return results_frame(spark, [row for part in rows for row in part])


def clean_parts(train: DataFrame, test: DataFrame, spelling: str = "context") -> tuple[DataFrame, DataFrame]:
    """Both parts as ``(doc_id, label, tokens)`` after the cleaning stages.

    What a stage learns comes from the training part; it is applied to both parts in one
    job. Each stage's output is stored before the next one reads it, since fitting and
    transforming would each compute it again. A document is in one of the parts only.
    """
    columns = ["doc_id", "label", "part"]
    parts = learner_partitions(train.sparkSession)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    # Laid out for the learners, which pass over what comes of this with one task a file.
    both = both.select(*columns, "text").repartition(parts, "doc_id")
    for stage in cleaning_stages(spelling):
        fitted = stage.fit(both.where("part = 'train'")) if isinstance(stage, Estimator) else stage
        name = type(stage).__name__.lower()
        both = materialize(fitted.transform(both).select(*columns, "tokens"), name)
    return tuple(both.where(F.col("part") == part).drop("part") for part in ("train", "test"))
