"""Accuracy, confusion matrix and area under the ROC curve, exact or between two bounds.

All of them take ``group`` columns, so that the predictions of many models are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.operators.order import running_sums


def accuracy(predictions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``n, accuracy, complement, invert``, one row or one for each group. ``invert`` says that
    answering the opposite would be right more often."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.groupBy(*group).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy")).select(
        *group,
        "n",
        "accuracy",
        (1.0 - F.col("accuracy")).alias("complement"),
        (F.col("accuracy") < 0.5).alias("invert"),
    )


def confusion(predictions: DataFrame) -> DataFrame:
    """``(label, prediction, n)``."""
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def _by_class() -> list[Column]:
    return [
        F.sum((F.col("label") == 1).cast("long")).alias("p"),
        F.sum((F.col("label") == 0).cast("long")).alias("n"),
    ]


def _pairs() -> Column:
    """Positive/negative pairs, as a double."""
    return F.col("n_pos").cast("double") * F.col("n_neg")


def auc(predictions: DataFrame, score: str = "score", name: str = "scores", group: Sequence[str] = ()) -> DataFrame:
    """``(n_pos, n_neg, auc)``, one row or one for each group: the share of positive/negative pairs
    in the right order, ties counting half; null when a class is missing.

    Equal scores are counted together first, so the running sums go over distinct scores of
    each group, and they are taken over ranges, not in one task a group.
    """
    group = list(group)
    per_score = predictions.groupBy(*group, F.col(score).alias("score")).agg(*_by_class())
    ordered = running_sums(per_score, [F.asc("score")], {"n": "n_below"}, name, group)
    total = ordered.groupBy(*group).agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_neg"),
        F.sum(F.col("p") * (F.col("n_below") + F.col("n") / 2.0)).alias("ordered"),
    )
    return total.select(
        *group, "n_pos", "n_neg", F.when(_pairs() > 0, F.col("ordered") / _pairs()).alias("auc")
    )


def histogram(
    predictions: DataFrame, low: float, high: float, bins: int, score: str = "score", group: Sequence[str] = ()
) -> DataFrame:
    """``(bin, p, n)`` of the scores: how many of each class fall into each of ``bins`` equal steps from
    ``low`` to ``high``; what is outside counts to the nearest.

    Histograms of the same steps are added by summing ``p`` and ``n`` by bin, so parts of a
    table can be evaluated on their own, and later together.
    """
    step = F.floor((F.col(score) - F.lit(float(low))) / F.lit((high - low) / bins))
    place = F.least(F.greatest(step, F.lit(0)), F.lit(bins - 1)).cast("int")
    return predictions.groupBy(*group, place.alias("bin")).agg(*_by_class())


def auc_bounds(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(n_pos, n_neg, auc_low, auc_high)`` from a :func:`histogram`, without a sort of the scores.

    Pairs in different bins are in a known order. Of those in one bin, all or none may be in the
    right one, so the exact AUC lies between the bounds, and their mean is off by at most half of
    ``auc_high - auc_low``. Null when a class is missing. A group has one row for each bin.
    """
    below = Window.partitionBy(*(group or [F.lit(0)])).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("n_below", F.coalesce(F.sum("n").over(below), F.lit(0)))
    total = before.groupBy(*group).agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_neg"),
        F.sum(F.col("p").cast("double") * F.col("n_below")).alias("sure"),
        F.sum(F.col("p").cast("double") * F.col("n")).alias("open"),
    )
    share = lambda pairs: F.when(_pairs() > 0, pairs / _pairs())
    return total.select(
        *group,
        "n_pos",
        "n_neg",
        share(F.col("sure")).alias("auc_low"),
        share(F.col("sure") + F.col("open")).alias("auc_high"),
    )
