"""Feature vectors in long form, ``(doc_id, index, value)``, and as vectors for Spark ML.

An index comes from a table, by a join: the rank of a token in the vocabulary, or the bucket of its
hash. So no vocabulary passes through the driver, and the statistics of a part or of a fold are
sums over rows. Vectors for a learner are put together from the rows, one document a row, and
stored in as many partitions as the learner should use.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import ElementwiseProduct, HashingTF
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinia.functions import rows
from opinia.operators.joins import lookup_join
from opinia.operators.terms import idf_column, vocabulary
from opinia.session import materialize

#: Weights are broadcast up to so many rows, and no more bytes than other lookups.
WEIGHT_ROWS = 1 << 20
#: The kind of a sparse vector in the storage form of Spark ML.
SPARSE = 0


def token_counts_by(terms: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(*keep, token, tf)`` of stored ``terms`` arrays."""
    return rows.inline(terms, list(keep), "terms", "token")


def token_stats(terms: DataFrame, where: str | None = None) -> DataFrame:
    """``(token, df, n)`` of the documents of a part; all tokens of the table with ``rows``, the
    documents that have them at all."""
    inside = F.expr(where) if where else F.lit(True)
    long = rows.inline(terms.withColumn("_inside", inside), ["_inside"], "terms", "token")
    return materialize(
        long.groupBy("token").agg(
            F.sum(F.col("_inside").cast("long")).alias("df"),
            F.coalesce(F.sum(F.when(F.col("_inside"), F.col("tf"))), F.lit(0)).cast("long").alias("n"),
            F.count("*").alias("rows"),
        ),
        "token-stats",
    )


def token_buckets(stats: DataFrame, num_features: int) -> DataFrame:
    """``(token, bucket, rows)``: where Spark ML's hash puts each token. Hashed once a distinct token."""
    hashed = HashingTF(inputCol="_one", outputCol="_vector", numFeatures=num_features).transform(
        stats.select("token", "rows", F.array("token").alias("_one"))
    )
    # A vector's fields can be read where it is written as JSON; this one has a single index.
    bucket = F.get_json_object(F.to_json(F.struct("_vector")), "$._vector.indices[0]").cast("int")
    return materialize(hashed.select("token", bucket.alias("bucket"), "rows"), "buckets")


def hashed_counts(terms: DataFrame, buckets: DataFrame, keep: Sequence[str], dropped: dict[str, list[str]]) -> DataFrame:
    """``(strategy, *keep, bucket, tf)``: occurrences by bucket of each document's tokens that the strategy
    does not drop. Tokens that share a bucket are added here, so they count as one term from here on.
    """
    keep = list(keep)
    long = token_counts_by(terms, keep)
    placed = lookup_join(long, buckets.select("token", "bucket"), ["token"], "inner", ["doc_id"], buckets, "rows")

    def kept(words: list[str]):
        stop = sorted({w.lower() for w in words})
        return ~F.lower("token").isin(stop) if stop else F.lit(True)

    sums = placed.groupBy(*keep, "bucket").agg(
        *[F.sum(F.when(kept(words), F.col("tf"))).cast("long").alias(f"tf_{s}") for s, words in dropped.items()]
    )
    each = F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(f"tf_{s}").alias("tf")) for s in dropped])
    return sums.select(*keep, "bucket", F.inline(each)).where("tf > 0").select("strategy", *keep, "bucket", "tf")


def weighted(counts: DataFrame, inside: str, n_docs: int, by: Sequence[str], index: str) -> DataFrame:
    """``counts`` with ``tf_idf``: the inverse document frequency of each ``index`` within ``by``, learned
    from the rows where ``inside`` holds, of ``n_docs`` documents. What they lack has frequency 0.
    ``counts`` should be a stored table."""
    by = [*by, index]
    learned = counts.groupBy(*by).agg(
        F.sum(F.when(F.expr(inside), F.lit(1)).otherwise(0)).alias("df"), F.count("*").alias("rows")
    )
    learned = materialize(learned, "index-df")
    # One row for each bucket and setting, whatever the corpus, so a larger one than others is broadcast.
    known = lookup_join(counts, learned.drop("rows"), by, "inner", ["doc_id"], learned, "rows", WEIGHT_ROWS)
    return known.withColumn("tf_idf", F.col("tf") * idf_column(F.col("df"), n_docs))


def leave_out_df(counts: DataFrame, folds: int, fold: str = "fold", index: str = "bucket") -> DataFrame:
    """``(fold, bucket, df)``: for each fold the documents of all other folds that have a bucket.

    Document frequencies are additive, so every fold is counted once, in one aggregation, and
    taken off the total; no document of a fold can move its own row. Buckets with none are left out.
    """
    each = [F.sum((F.col(fold) == f).cast("long")) for f in range(folds)]
    sums = counts.groupBy(index).agg(F.count("*").alias("_all"), *[c.alias(f"_{f}") for f, c in enumerate(each)])
    others = F.array(
        *[F.struct(F.lit(f).alias(fold), (F.col("_all") - F.col(f"_{f}")).alias("df")) for f in range(folds)]
    )
    return sums.select(index, F.inline(others)).where("df > 0").select(fold, index, "df")


def vocabulary_counts(terms: DataFrame, vocab: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(*keep, index, df, tf)``: the tokens of a vocabulary table ``(index, token, df, rows)``, which is
    joined, not held."""
    long = token_counts_by(terms, keep)
    found = lookup_join(long, vocab.select("token", "index", "df"), ["token"], "inner", ["doc_id"], vocab, "rows")
    return found.select(*keep, "index", "df", "tf")


def train_vocabulary(stats: DataFrame, vocab_size: int) -> DataFrame:
    """``(index, token, n, df, rows)`` of :func:`token_stats`, stored: the tokens that the part has."""
    ranked = vocabulary(stats, vocab_size).select("index", "token", "n", "df")
    return materialize(ranked.join(stats.select("token", "rows"), "token"), "vocabulary")


def stored_vectors(
    docs: DataFrame, entries: DataFrame, size: int, value: str, index: str, partitions: int | None = None
) -> DataFrame:
    """``docs`` with ``features``: a sparse vector of ``size`` from ``entries (doc_id, index, value)``, for
    Spark ML. Documents without entries have an empty one.

    Written in ``partitions`` files (by default, one for each shuffle partition), since a learner
    passes over its table many times with one task a file.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = entries.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(index, value))).alias("_e"))
    # The storage form of a vector, which is read back as one.
    vector = F.struct(
        F.lit(SPARSE).cast("byte").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.coalesce(F.col(f"_e.{index}").cast("array<int>"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col(f"_e.{value}").cast("array<double>"), F.array().cast("array<double>")).alias("values"),
    )
    plain = docs.join(lists, "doc_id", "left").repartition(partitions, "doc_id").select(*docs.columns, vector.alias("features"))
    fields = [f for f in plain.schema.fields if f.name != "features"]
    return materialize(plain, "vectors", T.StructType([*fields, T.StructField("features", VectorUDT())]))


def scaled(vectors: DataFrame, weights: np.ndarray, column: str = "features") -> DataFrame:
    """The vectors with every entry times the weight of its index."""
    by = ElementwiseProduct(scalingVec=DenseVector(weights), inputCol=column, outputCol="_scaled")
    return by.transform(vectors).drop(column).withColumnRenamed("_scaled", column)
