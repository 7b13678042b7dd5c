"""Feature pipelines per stop-word strategy. Every call builds fresh stages: a stage that is
shared between pipelines and then re-wired would silently make them all the same."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame

from opinia.functions import lists
from opinia.operators.stages import (
    Annotate,
    DropStopWords,
    Finish,
    Lemmatize,
    SpellCheck,
    StableCountVectorizer,
    stop_words_of,
)

STRATEGIES = ("sw_pre", "sw_cstm", "sw_none")


def hashing_tf(df: DataFrame, words: str = "words", out: str = "rawFeatures", num_features: int = 1 << 18) -> DataFrame:
    """Hashed term frequencies, with Spark ML's own hash."""
    return HashingTF(inputCol=words, outputCol=out, numFeatures=num_features).transform(df)


def cleaning_stages(spelling: str = "context", dictionary: DataFrame | None = None, lemmas: DataFrame | None = None) -> list:
    """Tokens, spelling ('context', 'word' or 'none') and lemmas: the same for all strategies."""
    stages: list = [Annotate()]
    if spelling != "none":
        stages.append(SpellCheck(context=spelling == "context", dictionary=dictionary))
    return [*stages, Lemmatize(lemmas)]


def vector_stages(strategy: str, vectorizer: str = "hashing", num_features: int = 1 << 18, keep=lists.NEGATIONS) -> list:
    """Stop words, finisher, term counts and IDF."""
    stop = stop_words_of(strategy)
    stages: list = [] if stop is None else [DropStopWords(stop, keep)]
    stages.append(Finish())
    if vectorizer == "hashing":
        stages.append(HashingTF(inputCol="finished", outputCol="rawFeatures", numFeatures=num_features))
    elif vectorizer == "count":
        stages.append(StableCountVectorizer(vocab_size=num_features))
    else:
        raise ValueError(f"unknown vectorizer {vectorizer!r}; known: hashing, count")
    return [*stages, IDF(inputCol="rawFeatures", outputCol="features")]


def build_pipeline(strategy: str, model=None, spelling: str = "context", vectorizer: str = "hashing",
                   num_features: int = 1 << 18, keep=lists.NEGATIONS, dictionary: DataFrame | None = None,
                   lemmas: DataFrame | None = None) -> Pipeline:
    """Text to features, and to predictions when a classifier is given."""
    stages = [
        *cleaning_stages(spelling, dictionary, lemmas),
        *vector_stages(strategy, vectorizer, num_features, keep),
    ]
    return Pipeline(stages=stages if model is None else [*stages, model])
