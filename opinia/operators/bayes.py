"""Naive Bayes for many settings at once: validation folds, smoothing values, cleaning strategies.

A naive Bayes model is a table of counts, and counts are additive. What a model learns from all
folds but one is the total minus that fold's own counts, and what it learns under a stop list is
the counts without some tokens. So the text is read once, the counts are made once, and every
document gets its scores under all settings from one join with them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.functions import rows
from opinia.functions import text as X
from opinia.operators.joins import lookup_join
from opinia.session import materialize

# The smoothing values that are searched.
SMOOTHING = [0.1, 0.5, 1.0, 2.0]


def stored_terms(df: DataFrame, keep: Sequence[Column], words: str = "words") -> DataFrame:
    """``doc_id, label, terms`` and further columns, stored: the text is tokenized here and
    nowhere else. Documents without tokens stay."""
    return materialize(df.select("doc_id", "label", *keep, X.token_counts(F.col(words)).alias("terms")), "terms")


def _by_class(value: Column) -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("label") == label, value)), F.lit(0)).alias(name)
        for label, name in ((1, "p"), (0, "q"))
    ]


def left_out_counts(terms: DataFrame, fold: str = "fold") -> DataFrame:
    """``(token, fold, n, own_p, own_q, p, q, first)``: of each token and fold that has it, the documents
    there, the occurrences there by class, and those in all other folds; ``first`` marks one
    row of each token.

    Each fold is counted once; the others come from a token's total, one row a fold.
    """
    long = rows.inline(terms, ["label", fold], "terms", "token")
    own = long.groupBy("token", fold).agg(F.count("*").alias("n"), *_by_class(F.col("tf")))
    token = Window.partitionBy("token")
    return materialize(
        own.select(
            "token",
            fold,
            "n",
            F.col("p").alias("own_p"),
            F.col("q").alias("own_q"),
            (F.sum("p").over(token) - F.col("p")).alias("p"),
            (F.sum("q").over(token) - F.col("q")).alias("q"),
            (F.min(fold).over(token) == F.col(fold)).alias("first"),
        ),
        "left-out",
    )


def _prior(pos: int, neg: int) -> float:
    if not pos or not neg:
        raise ValueError("naive Bayes needs documents of both classes, labelled 0 and 1")
    return math.log(pos / neg)


def _rounded(score: Column) -> Column:
    """So that equal documents tie whatever the order of summation."""
    return F.round(score, 6) + F.lit(0.0)


def fold_scores(
    df: DataFrame,
    fold: Column,
    held_out: Sequence[int],
    smoothing: Sequence[float] = SMOOTHING,
    words: str = "words",
) -> DataFrame:
    """``(doc_id, label, fold, smoothing, score, prediction)`` of the documents of the folds
    ``held_out``, each scored by the model of all other folds, for every smoothing value.

    ``df`` is ``(doc_id, label, words)``. Tokens that the other folds lack are skipped.
    """
    terms = stored_terms(df, [fold.cast("int").alias("fold")], words)
    stats = left_out_counts(terms)
    # The driver gets a row for each fold, here and below.
    docs = {r["fold"]: (r["p"], r["q"]) for r in terms.groupBy("fold").agg(*_by_class(F.lit(1))).collect()}
    sums = {
        r["fold"]: r
        for r in stats.groupBy("fold").agg(
            F.sum("own_p").alias("p"), F.sum("own_q").alias("q"),
            F.count_if(F.col("p") + F.col("q") == 0).alias("alone"), F.count_if("first").alias("v"),
        ).collect()
    }
    held_out = [f for f in held_out if f in docs]
    all_docs = [sum(x[i] for x in docs.values()) for i in (0, 1)]
    total = {c: sum(r[c] for r in sums.values()) for c in ("p", "q", "v")}
    none = {"p": 0, "q": 0, "alone": 0}
    of_fold = {}
    for f in held_out:
        own = sums.get(f, none)
        vocab = total["v"] - own["alone"]
        of_fold[f] = (
            _prior(*(a - b for a, b in zip(all_docs, docs[f]))),
            # What every known token adds besides its own counts.
            [
                math.log(total["q"] - own["q"] + s * vocab) - math.log(total["p"] - own["p"] + s * vocab) if vocab else 0.0
                for s in smoothing
            ],
        )
    scored = terms.where(F.col("fold").isin(list(of_fold)))
    long = rows.inline(scored, ["doc_id", "fold"], "terms", "token")
    known = stats.where(F.col("p") + F.col("q") > 0).select("token", "fold", "p", "q")
    hits = lookup_join(long, known, ["token", "fold"], "inner", ["doc_id"], stats, "n")
    evidence = hits.groupBy("doc_id").agg(
        F.sum("tf").alias("known"),
        *[
            F.sum(F.col("tf") * (F.log(F.col("p") + F.lit(s)) - F.log(F.col("q") + F.lit(s)))).alias(f"e{i}")
            for i, s in enumerate(smoothing)
        ],
    )

    def by_fold(value) -> Column:
        out = F.lit(None).cast("double")
        for f, known_of in of_fold.items():
            out = F.when(F.col("fold") == f, F.lit(value(known_of))).otherwise(out)
        return out

    each = F.array(
        *[
            F.struct(
                F.lit(float(s)).alias("smoothing"),
                _rounded(
                    by_fold(lambda k: k[0])
                    + F.coalesce(f"e{i}", F.lit(0.0))
                    + F.coalesce("known", F.lit(0)) * by_fold(lambda k, i=i: k[1][i])
                ).alias("score"),
            )
            for i, s in enumerate(smoothing)
        ]
    )
    joined = scored.select("doc_id", "label", "fold").join(evidence, "doc_id", "left")
    found = joined.select("doc_id", "label", "fold", F.inline(each))
    return found.withColumn("prediction", (F.col("score") > 0).cast("double"))


def strategy_scores(
    df: DataFrame, part: Column, dropped: dict[str, list[str]], train: str = "train", words: str = "words"
) -> DataFrame:
    """``(doc_id, label, part, strategy, score, prediction)`` of all documents, by the model that
    each strategy's words make of the part ``train``.

    ``df`` is ``(doc_id, label, words)``, ``dropped`` the stop words of each strategy.
    """
    terms = stored_terms(df, [part.alias("part")], words)
    learnt = terms.where(F.col("part") == train)
    counted = rows.inline(terms, ["label", "part"], "terms", "token").groupBy("token").agg(
        F.count("*").alias("n"),
        *[
            F.coalesce(F.sum(F.when((F.col("part") == train) & (F.col("label") == label), F.col("tf"))), F.lit(0)).alias(c)
            for label, c in ((1, "p"), (0, "q"))
        ],
    )
    stats = materialize(counted, "part-counts")

    def kept(strategy: str) -> Column:
        stop = sorted({w.lower() for w in dropped[strategy]})
        return ~F.lower("token").isin(stop) if stop else F.lit(True)

    seen = F.col("p") + F.col("q") > 0
    sums = stats.where(seen).agg(
        *[
            F.coalesce(F.sum(F.when(kept(s), F.col(c))), F.lit(0)).alias(f"{c}_{s}") if c != "v"
            else F.count_if(kept(s)).alias(f"v_{s}")
            for s in dropped for c in ("p", "q", "v")
        ]
    ).first()
    prior = _prior(*learnt.agg(*_by_class(F.lit(1))).first())
    long = rows.inline(terms, ["doc_id"], "terms", "token")
    hits = lookup_join(long, stats.where(seen).select("token", "p", "q"), ["token"], "inner", ["doc_id"], stats, "n")
    weight = F.col("tf") * (F.log(F.col("p") + 1) - F.log(F.col("q") + 1))
    evidence = hits.groupBy("doc_id").agg(
        *[F.sum(F.when(kept(s), weight)).alias(f"e_{s}") for s in dropped],
        *[F.sum(F.when(kept(s), F.col("tf"))).alias(f"k_{s}") for s in dropped],
    )
    each = []
    for s in dropped:
        v = sums[f"v_{s}"]
        rest = math.log(sums[f"q_{s}"] + v) - math.log(sums[f"p_{s}"] + v) if v else 0.0
        score = F.lit(prior) + F.coalesce(f"e_{s}", F.lit(0.0)) + F.coalesce(f"k_{s}", F.lit(0)) * F.lit(rest)
        each.append(F.struct(F.lit(s).alias("strategy"), _rounded(score).alias("score")))
    joined = terms.select("doc_id", "label", "part").join(evidence, "doc_id", "left")
    found = joined.select("doc_id", "label", "part", F.inline(F.array(*each)))
    return found.withColumn("prediction", (F.col("score") > 0).cast("double"))
