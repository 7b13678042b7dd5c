"""Lemmatization by dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.functions import rows
from opinia.operators.joins import lookup_join
from opinia.operators.tokens import map_tokens
from opinia.session import materialize

# Endings that the corpus-derived lemma table strips.
ENDINGS = ["ing", "ed", "tion", "s"]


def derive_lemmas(words: DataFrame, endings: list[str] = ENDINGS, min_stem: int = 3) -> DataFrame:
    """``(form, lemma)`` from the corpus itself: a form whose stem is also a token.

    ``words`` is ``(token, ...)``, one row per distinct token. Each form emits its possible
    stems, which are looked up by equality; several hits give the smallest stem.
    """
    stems = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("form").endswith(e) & (F.length("form") - len(e) >= min_stem),
                    F.expr(f"left(form, length(form) - {len(e)})"),
                )
                for e in endings
            ]
        )
    )
    forms = rows.explode(words.withColumnRenamed("token", "form"), ["form"], stems, "stem")
    known = words.select(F.col("token").alias("stem"))
    return forms.join(known, "stem").groupBy("form").agg(F.min("stem").alias("lemma"))


def _as_lookup(lemmas: DataFrame) -> DataFrame:
    return materialize(lemmas.groupBy(F.col("form").alias("token")).agg(F.min("lemma").alias("lemma")), "lemma-lookup")


def lemmatize(long: DataFrame, lemmas: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Add ``lemma`` to ``(doc_id, sent, pos, token)``; unknown tokens are their own lemma."""
    joined = lookup_join(long, _as_lookup(lemmas), ["token"], "left", ["doc_id", "sent", "pos"], counts)
    return joined.select(*long.columns, F.coalesce("lemma", "token").alias("lemma"))


def lemmatize_wide(
    df: DataFrame, lemmas: DataFrame, tokens: str = "tokens", counts: DataFrame | None = None
) -> DataFrame:
    """The same on an annotation array: only tokens that have another lemma are regrouped."""
    places = rows.posexplode(df, ["doc_id"], f"{tokens}.result", "i", "token")
    changed = _as_lookup(lemmas).where(F.col("lemma") != F.col("token"))
    hits = lookup_join(places, changed, ["token"], "inner", ["doc_id", "i"], counts)
    return map_tokens(df, hits.select("doc_id", "i", F.col("lemma").alias("value")), tokens)
