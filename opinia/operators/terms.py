"""Term statistics: counts per document, document frequency, IDF, TF-IDF, vocabulary, n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.functions import rows
from opinia.functions import text as X
from opinia.operators.joins import lookup_join
from opinia.operators.order import running_sums


def ngrams(df: DataFrame, words: str = "words", out: str = "bigrams", n: int = 2) -> DataFrame:
    return df.withColumn(out, X.ngrams(F.col(words), n))


def term_counts(df: DataFrame, words: str = "words") -> DataFrame:
    """``(doc_id, ..., token, tf)``: raw counts per document, without a shuffle."""
    others = [c for c in df.columns if c != words]
    return rows.inline(df, others, X.token_counts(F.col(words)), "token")


def term_freq(df: DataFrame, words: str = "words") -> DataFrame:
    """Counts divided by the number of tokens of the document."""
    return term_counts(df.select("doc_id", F.size(words).alias("n_tokens"), words), words).withColumn(
        "freq", F.col("tf") / F.col("n_tokens")
    )


def term_stats(df: DataFrame, words: str = "words") -> DataFrame:
    """``(token, df, n)``: documents that hold a token, and occurrences.

    A document's tokens are sorted inside its row, and each is beside the one before it, so the first of
    its kind counts for the document frequency: plain counts with map-side combining, no distinct count.
    """
    ordered = F.sort_array(words)
    before = F.concat(F.array(F.lit(None).cast("string")), ordered)
    pairs = F.arrays_zip(ordered.alias("token"), before.alias("before"))
    # The second list is longer by one.
    places = rows.inline(df, [], pairs, "token")
    first = F.col("before").isNull() | (F.col("before") != F.col("token"))
    return places.groupBy("token").agg(F.count_if(first).alias("df"), F.count("*").alias("n"))


def idf_column(df: Column, n_docs: int) -> Column:
    """Smoothed as in Spark ML: ``ln((m + 1) / (df + 1))``."""
    return F.log(F.lit(float(n_docs + 1)) / (df + 1))


def idf(stats: DataFrame, n_docs: int, min_df: int = 0) -> DataFrame:
    """``(token, df, idf)``. As in Spark ML, terms below ``min_df`` get weight 0."""
    weight = idf_column(F.col("df"), n_docs)
    if min_df > 0:
        weight = F.when(F.col("df") >= min_df, weight).otherwise(F.lit(0.0))
    return stats.select("token", "df", weight.alias("idf"))


def tf_idf(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """``counts (doc_id, token, tf)`` times ``weights (token, df, idf)``.

    The document frequency is also the number of ``counts`` rows per token, so it says
    which tokens to spread; ``weights`` should be a stored table, since it is read for both.
    """
    joined = lookup_join(counts, weights, ["token"], "inner", ["doc_id"], weights, "df")
    return joined.select("doc_id", "token", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def top_per_document(scored: DataFrame, value: str, k: int = 5) -> DataFrame:
    """The best ``k`` terms of each document; ties go to the smaller token."""
    ranked = Window.partitionBy("doc_id").orderBy(F.desc(value), "token")
    return scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def vocabulary(
    stats: DataFrame, vocab_size: int | None = None, min_df: int = 1, name: str = "vocab"
) -> DataFrame:
    """``(index, token, n, df)``: all terms, the most frequent first, ties by token, so that
    indexes do not depend on the data layout; or the first ``vocab_size`` of them. Ranks come
    from range partitions, not from one sort."""
    order = [F.desc("n"), F.asc("token")]
    counted = stats.where(F.col("df") >= min_df).withColumn("one", F.lit(1))
    ranked = running_sums(counted, order, {"one": "index"}, name)
    if vocab_size is not None:
        ranked = ranked.where(F.col("index") < vocab_size)
    return ranked.select(F.col("index").cast("long").alias("index"), "token", "n", "df")


def top_terms(stats: DataFrame, k: int = 50) -> DataFrame:
    """The most frequent terms: candidates for a stop list."""
    return stats.select("token", "n", "df").orderBy(F.desc("n"), "token").limit(k)


def top_ngrams(df: DataFrame, words: str = "words", n: int = 2, k: int = 50) -> DataFrame:
    """The most frequent n-grams with their share in each class. ``df`` has ``label``."""
    grams = rows.explode(df, ["label"], X.ngrams(F.col(words), n), "ngram")
    return (
        grams.groupBy("ngram")
        .agg(
            F.count("*").alias("n"),
            F.sum((F.col("label") == 1).cast("long")).alias("n_pos"),
            F.sum((F.col("label") == 0).cast("long")).alias("n_neg"),
        )
        .withColumn("pos_share", F.col("n_pos") / F.col("n"))
        .orderBy(F.desc("n"), "ngram")
        .limit(k)
    )
