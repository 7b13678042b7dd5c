"""Word lists that callers can use as they are or replace."""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path
from zipfile import ZipFile

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover

# The custom stop list.
CUSTOM_STOP_WORDS = [
    "the", "be", "now", "get", "on", "and", "so", "want", "I", "it", "that", "honesty", "you",
    "they", "them", "this", "by", "during", "holiday", "off", "back", "what", "say", "to",
    "still", "end", "up", "way", "little", "in", "let", "alone", "at", "all", "because", "oh",
    "stuff", "red", "that's", "a", "of", "some",
]

# Negations that carry the sentiment of a sentence and therefore survive every stop list.
NEGATIONS = [
    "not", "no", "nor", "never", "none", "cannot", "without", "don't", "doesn't", "didn't",
    "isn't", "aren't", "wasn't", "weren't", "can't", "couldn't", "won't", "wouldn't",
    "shouldn't", "hasn't", "haven't", "hadn't",
]


def default_stop_words(language: str = "english") -> list[str]:
    """The stop list that ships with Spark ML; read from its jar while no session runs."""
    if SparkContext._active_spark_context is not None:
        return list(StopWordsRemover.loadDefaultStopWords(language))
    jars = Path(os.environ.get("SPARK_HOME", Path(pyspark.__file__).parent)) / "jars"
    jar = next(jars.glob("spark-mllib_*.jar"))
    with ZipFile(jar) as resources:
        text = resources.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt")
    return text.decode("utf-8").split()


def without(stop: Iterable[str], keep: Iterable[str] = NEGATIONS) -> list[str]:
    """A stop list minus the words to keep."""
    kept = {w.lower() for w in keep}
    return [w for w in stop if w.lower() not in kept]
