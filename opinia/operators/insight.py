"""Which terms mark a class, and what the stop-word strategies change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from opinia.operators.terms import term_counts


def class_counts(df: DataFrame, words: str = "words") -> DataFrame:
    """``(token, df_pos, df_neg, n_pos, n_neg)``: documents and occurrences by class."""
    pos, neg = F.col("label") == 1, F.col("label") == 0
    return (
        term_counts(df.select("label", words), words)
        .groupBy("token")
        .agg(
            F.sum(pos.cast("long")).alias("df_pos"),
            F.sum(neg.cast("long")).alias("df_neg"),
            F.sum(F.when(pos, F.col("tf")).otherwise(0)).alias("n_pos"),
            F.sum(F.when(neg, F.col("tf")).otherwise(0)).alias("n_neg"),
        )
    )


def buzzwords(counts: DataFrame, k: int = 25, min_count: int = 5) -> DataFrame:
    """``(class, rank, token, n_pos, n_neg, log_odds)``: the terms that speak most for each class.

    ``counts`` is a stored table of :func:`class_counts`. Odds are smoothed by one and
    rounded, so that equal terms tie and the token decides; each class is a top-k of its
    own, so no task sees more than k rows per input partition.
    """
    size = counts.agg(F.count("*"), F.sum("n_pos"), F.sum("n_neg")).first()
    vocab, total_pos, total_neg = size[0], size[1] or 0, size[2] or 0
    odds = counts.where(F.col("n_pos") + F.col("n_neg") >= min_count).select(
        "token",
        "n_pos",
        "n_neg",
        F.round(
            F.log((F.col("n_pos") + 1) / F.lit(float(total_pos + vocab)))
            - F.log((F.col("n_neg") + 1) / F.lit(float(total_neg + vocab))),
            9,
        ).alias("log_odds"),
    )

    def best(label: int) -> DataFrame:
        strongest = F.desc("log_odds") if label == 1 else F.asc("log_odds")
        top = odds.orderBy(strongest, "token").limit(k)
        by_rank = Window.partitionBy("class").orderBy(strongest, "token")
        return (
            top.withColumn("class", F.lit(label))
            .withColumn("rank", F.row_number().over(by_rank))
            .select("class", "rank", "token", "n_pos", "n_neg", "log_odds")
        )

    return best(1).unionByName(best(0))


def term_label_association(counts: DataFrame, n_pos: int, n_neg: int, low: int = 5) -> DataFrame:
    """``(token, df, chi2, pmi, low_count)``: how far a term's presence depends on the label.
    ``low_count`` marks terms of fewer than ``low`` documents, whose numbers mean little.

    ``counts`` is :func:`class_counts`; ``n_pos`` and ``n_neg`` are documents per class.
    """
    n = float(n_pos + n_neg)
    a, b = F.col("df_pos").cast("double"), F.col("df_neg").cast("double")
    c, d = F.lit(float(n_pos)) - a, F.lit(float(n_neg)) - b
    spread = (a + b) * (c + d) * F.lit(float(n_pos)) * F.lit(float(n_neg))
    chi2 = F.when(spread > 0, F.lit(n) * (a * d - b * c) * (a * d - b * c) / spread).otherwise(0.0)
    pmi = F.when(a > 0, F.log(a * F.lit(n) / ((a + b) * F.lit(float(n_pos)))))
    df = F.col("df_pos") + F.col("df_neg")
    return counts.select(
        "token", df.alias("df"), chi2.alias("chi2"), pmi.alias("pmi"), (df < low).alias("low_count")
    )


def strategy_stats(stats: DataFrame, n_docs: int, dropped: dict[str, list[str]]) -> DataFrame:
    """``(strategy, n_docs, n_tokens, n_terms)`` for each strategy's list of dropped words.

    Dropping stop words is a matter of each token, so the counts of all strategies come from
    one pass over ``stats (token, df, n)``, a row per distinct term.
    """
    sums = []
    for name, words in dropped.items():
        left = ~F.lower("token").isin(sorted({w.lower() for w in words})) if words else F.lit(True)
        sums += [
            F.coalesce(F.sum(F.when(left, F.col("n"))), F.lit(0)).alias(f"{name}_tokens"),
            F.count(F.when(left, F.lit(1))).alias(f"{name}_terms"),
        ]
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("strategy"),
                F.lit(n_docs).cast("long").alias("n_docs"),
                F.col(f"{name}_tokens").alias("n_tokens"),
                F.col(f"{name}_terms").alias("n_terms"),
            )
            for name in dropped
        ]
    )
    return stats.agg(*sums).select(F.inline(each))
