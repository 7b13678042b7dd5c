"""Stop-word removal, from a list or from a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.functions import lists
from opinia.functions import text as X
from opinia.operators.joins import lookup_join
from opinia.session import materialize


def remove_stop_words(
    df: DataFrame,
    words: str = "words",
    out: str = "cleaned",
    stop: Iterable[str] | None = None,
    keep: Iterable[str] = (),
    case_sensitive: bool = False,
) -> DataFrame:
    """Drop listed words from a token list. Without ``stop`` the English list of Spark ML is
    used; words in ``keep`` are taken off the list first."""
    stop = lists.default_stop_words() if stop is None else stop
    return df.withColumn(out, X.drop_words(F.col(words), lists.without(stop, keep), case_sensitive))


def remove_stop_table(long: DataFrame, stop: DataFrame, keep: Iterable[str] = lists.NEGATIONS) -> DataFrame:
    """Drop the tokens that a ``(word)`` table lists, except those in ``keep``.

    ``long`` has ``(doc_id, sent, pos, token)`` in lower case."""
    kept = [w.lower() for w in keep]
    words = stop.select(F.lower("word").alias("token")).where(F.col("token").isNotNull())
    if kept:
        words = words.where(~F.col("token").isin(kept))
    stored = materialize(words.distinct(), "stop-words")
    return lookup_join(long, stored, ["token"], "left_anti", ["doc_id", "sent", "pos"]).select(
        *long.columns
    )


def drop_annotated(
    df: DataFrame, tokens: str, stop: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """The list form of the above on an annotation array."""
    lowered = sorted({w.lower() for w in lists.without(stop, keep)})
    return df.withColumn(tokens, F.filter(tokens, lambda t: ~F.lower(t["result"]).isin(lowered)))
