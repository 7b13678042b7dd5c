"""Reading the review table, its label, and small looks at it; writing the result store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.DoubleType()),
    ]
)

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise when a column is missing or has another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            problems.append(f"missing column {field.name}")
        elif actual[field.name] != field.dataType:
            problems.append(
                f"column {field.name} is {actual[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    if problems:
        raise ValueError("; ".join(problems))
    return df


def read_table(spark: SparkSession, source: str, name: str) -> DataFrame:
    """A parquet table in folder ``source``, or a catalog table when ``source`` is ''."""
    return spark.read.parquet(f"{source}/{name}.parquet") if source else spark.table(name)


def load_reviews(
    spark: SparkSession,
    source: str,
    table: str = "documents",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Iterable[str] = (),
) -> DataFrame:
    """``(doc_id, text, ...keep)``, with null text read as '' (``text_was_null`` marks it)."""
    df = read_table(spark, source, table).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(text_col).isNull().alias("text_was_null"),
        *keep,
    )
    return df


def with_label(df: DataFrame, label_col: str, out: str = "label") -> DataFrame:
    """The label as the double that Spark ML needs."""
    return df.withColumn(out, F.col(label_col).cast("double"))


def labelled_docs(spark: SparkSession, source: str, target: str = "quality") -> DataFrame:
    """``(doc_id, text, label)`` for the documents that carry a label."""
    docs = load_reviews(spark, source).drop("text_was_null")
    labels = with_label(read_table(spark, source, "labels"), target).select(
        F.col("doc_id").cast("long").alias("doc_id"), "label"
    )
    return docs.join(labels.where(F.col("label").isNotNull()), "doc_id")


def preview(df: DataFrame, n: int = 5, key: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by key: a look at the table that does not change between runs."""
    return df.orderBy(key).limit(n)


def corpus_profile(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Row counts by label (null = unlabelled), with the null and empty texts among them.

    ``docs`` has ``(doc_id, text, text_was_null)``, ``labels`` has ``(doc_id, label)``.
    """
    slim = docs.select(
        "doc_id", "text_was_null", (F.col("text") == "").alias("empty"), F.length("text").alias("chars")
    )
    return (
        slim.join(labels, "doc_id", "left")
        .groupBy("label")
        .agg(
            F.count("*").alias("n_docs"),
            F.sum(F.col("text_was_null").cast("long")).alias("n_null_text"),
            F.sum((F.col("empty") & ~F.col("text_was_null")).cast("long")).alias("n_empty_text"),
            F.sum("chars").alias("n_chars"),
        )
    )


def results_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """The result store: one row per (pipeline, model, params, metric)."""
    return spark.createDataFrame(list(rows), RESULT_SCHEMA)


def write_results(df: DataFrame, path: str, mode: str = "append") -> None:
    """Keep result rows; the report is a read of this table."""
    assert_schema(df, RESULT_SCHEMA).write.mode(mode).parquet(path)


def report_lines(df: DataFrame) -> DataFrame:
    """``pipeline - model: value`` lines of the result store."""
    return df.select(
        F.format_string("%s - %s: %s=%.6f", "pipeline", "model", "metric", "value").alias("line")
    )
