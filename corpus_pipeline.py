"""From raw documents to packed training sequences, in stages that are written and read again.

Quality rules and the toxicity machine drop documents, near duplicates leave one of each group,
mixing drops and repeats documents so that each source gets its share of words, and packing
places token pieces in sequences.

Every stage takes any number of rows, null ids and texts, and columns beyond those of
``documents``, which it keeps; see the operators' modules for the results defined for these.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from opinia.llm import catalogue, mixing, packing, quality, simhash, toxicity
from opinia.llm.common import scratch_root, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model over the quality rules keeps."""
    return quality.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the labels are those of the corpus."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), sample=6000, threshold=0.3)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs, cycle=(1, 2, 3), most=3, seed=7)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces (``ids``) with their places in sequences of 2,048 tokens."""
    return packing.pack(catalogue.pieces_of(docs, 2048), 2048)


STAGES = [
    ("quality_rules", good),
    ("toxicity", clean),
    ("near_duplicates", one_of_each),
    ("mixing", in_proportion),
    ("packing", packed),
]

#: Models and tokenizers cannot be expressed in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
