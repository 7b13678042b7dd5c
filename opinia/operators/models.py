"""The train/test split, naive Bayes as joins and counts, and the Spark ML classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.operators.forests import SparseRandomForest
from opinia.operators.insight import class_counts
from opinia.operators.joins import lookup_join
from opinia.operators.terms import term_counts
from opinia.operators.trees import SparseDecisionTree
from opinia.session import materialize

SEED = 31415

# A new estimator on every call, so that no two pipelines share a stage.
ESTIMATORS: dict[str, Callable] = {
    "lr": LogisticRegression,
    "dt": SparseDecisionTree,
    "nb": NaiveBayes,
    "rf": SparseRandomForest,
    "svc": LinearSVC,
}


def estimator(name: str, **params):
    """A fresh classifier with Spark ML's parameters: lr, dt, nb, rf or svc."""
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(ESTIMATORS)}")
    return ESTIMATORS[name](**params)


def hash_bucket(key: str, seed: int, buckets: int) -> Column:
    """A number in ``0 .. buckets - 1`` that depends on the key and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)


def split_column(key: str = "doc_id", train_percent: int = 80, seed: int = SEED) -> Column:
    """'train' or 'test', the same for a document however the data is laid out."""
    return F.when(hash_bucket(key, seed, 100) < train_percent, "train").otherwise("test")


def split_train_test(
    df: DataFrame, train_percent: int = 80, seed: int = SEED, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("split", split_column(key, train_percent, seed))
    return (
        marked.where(F.col("split") == "train").drop("split"),
        marked.where(F.col("split") == "test").drop("split"),
    )


def class_sizes(df: DataFrame) -> tuple[int, int]:
    """Documents with label 1 and with label 0."""
    row = df.agg(
        F.sum((F.col("label") == 1).cast("long")), F.sum((F.col("label") == 0).cast("long"))
    ).first()
    return row[0] or 0, row[1] or 0


def nb_train(train: DataFrame, words: str = "words") -> tuple[DataFrame, Column]:
    """Multinomial naive Bayes for two classes: ``(token, n, weight)`` and the prior.

    ``weight`` is ``ln P(token | 1) - ln P(token | 0)`` with counts smoothed by one, so a
    document's score is the prior plus the weighted sum of its term counts.
    """
    counts = materialize(class_counts(train, words), "nb-counts")
    size = counts.agg(F.count("*"), F.sum("n_pos"), F.sum("n_neg")).first()
    vocab, total_pos, total_neg = size[0], size[1] or 0, size[2] or 0
    docs_pos, docs_neg = class_sizes(train)
    if not docs_pos or not docs_neg:
        raise ValueError("naive Bayes needs documents of both classes, labelled 0 and 1")
    prior = F.log(F.lit(float(docs_pos)) / F.lit(float(docs_neg)))
    weights = counts.select(
        "token",
        (F.col("n_pos") + F.col("n_neg")).alias("n"),
        (
            F.log((F.col("n_pos") + 1) / F.lit(float(total_pos + vocab)))
            - F.log((F.col("n_neg") + 1) / F.lit(float(total_neg + vocab)))
        ).alias("weight"),
    )
    return weights, prior


def nb_score(docs: DataFrame, weights: DataFrame, prior: Column, words: str = "words") -> DataFrame:
    """Every column of ``docs`` but the words, plus ``score`` (log odds) and ``prediction``.

    Terms unseen in training are skipped, and a document without known terms gets the prior.
    The score is rounded so that equal documents tie whatever the order of summation.
    """
    hits = lookup_join(
        term_counts(docs.select("doc_id", words), words),
        weights.select("token", "weight"),
        ["token"],
        "inner",
        ["doc_id"],
    )
    sums = hits.groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("weight")).alias("evidence"))
    score = F.round(prior + F.coalesce("evidence", F.lit(0.0)), 6)
    return (
        docs.drop(words)
        .join(sums, "doc_id", "left")
        .withColumn("score", score)
        .drop("evidence")
        .withColumn("prediction", (F.col("score") > 0).cast("double"))
    )


def score_column(predictions: DataFrame) -> Column:
    """The score for class 1 of a Spark ML classifier: its probability, or for a classifier
    without probabilities its margin."""
    if "probability" in predictions.columns:
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]
