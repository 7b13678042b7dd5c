"""Tokenizers as operators, and the wide and long token layouts.

Wide: one row per document with a token array, for per-document steps. Long: one row per
token, for corpus-level counts and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.functions import rows
from opinia.functions import text as X
from opinia.session import materialize


def tokenize_ws(df: DataFrame, out: str = "words", drop_empty: bool = False) -> DataFrame:
    """Lower-cased white-space tokens."""
    return df.withColumn(out, X.ws_words(F.col("text"), drop_empty))


def tokenize_regex(
    df: DataFrame,
    out: str = "words",
    pattern: str | None = None,
    gaps: bool = False,
    min_length: int = 1,
    unicode: bool = False,
) -> DataFrame:
    """Lower-cased regex tokens: runs of ASCII word characters unless told otherwise."""
    pattern = pattern or (X.TOKENS_UNICODE if unicode else X.WORDS)
    return df.withColumn(out, X.words(F.col("text"), pattern, gaps, min_length))


def token_count(df: DataFrame, words: str = "words", out: str = "tokens") -> DataFrame:
    """The number of tokens, as an integer."""
    return df.withColumn(out, F.size(words))


def assemble(df: DataFrame, text: str = "text", out: str = "document", trim: bool = True) -> DataFrame:
    """The text as a one-element annotation array; null counts as ''."""
    whole = F.coalesce(F.col(text), F.lit(""))
    whole = F.trim(whole, F.lit(X.BLANKS)) if trim else whole
    return df.withColumn(
        out,
        F.array(
            F.struct(
                whole.alias("result"),
                F.lit(0).alias("begin"),
                (F.length(whole) - 1).alias("end"),
                F.lit(0).alias("sent"),
            )
        ),
    )


def sentences(docs: DataFrame) -> DataFrame:
    """``(doc_id, sent, sentence)``."""
    return rows.posexplode(docs, ["doc_id"], X.sentences(F.col("text")), "sent", "sentence")


def sentence_tokens(docs: DataFrame) -> DataFrame:
    """``(doc_id, sent, pos, token)`` by the rule tokenizer, which keeps case and marks."""
    per_sentence = F.transform(
        X.sentences(F.col("text")), lambda s: F.regexp_extract_all(s, F.lit(X.RULE_TOKENS), F.lit(0))
    )
    return long_tokens(docs, per_sentence)


def long_tokens(docs: DataFrame, per_sentence: Column) -> DataFrame:
    """``(doc_id, sent, pos, token)`` from token lists per sentence."""
    by_sentence = rows.posexplode(docs, ["doc_id"], per_sentence, "sent", "ts")
    return rows.posexplode(by_sentence, ["doc_id", "sent"], "ts", "pos", "token")


def token_table(
    docs: DataFrame,
    pattern: str = X.TOKENS,
    lowercase: bool = True,
    offsets: bool = False,
) -> DataFrame:
    """``(doc_id, sent, pos, token[, begin, end])`` by a custom token pattern."""
    if offsets:
        return to_long(annotate(docs, "tokens", pattern, lowercase, True))
    return long_tokens(
        docs, F.transform(X.sentences(F.col("text")), lambda s: X.extract(s, pattern, lowercase))
    )


def annotate(
    docs: DataFrame,
    out: str = "tokens",
    pattern: str | None = None,
    lowercase: bool = True,
    offsets: bool = False,
    keep_hyphen: bool = False,
    unicode: bool = False,
) -> DataFrame:
    """Add the tokens of each sentence as an annotation array."""
    pattern = pattern or (
        X.TOKENS_UNICODE if unicode else X.TOKENS_HYPHEN if keep_hyphen else X.TOKENS
    )
    return docs.withColumn(out, X.annotated_tokens(F.col("text"), pattern, lowercase, offsets))


def to_long(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(doc_id, sent, pos, token, ...)`` from an annotation array."""
    return rows.explode(df, ["doc_id"], tokens, "t").select(
        "doc_id", "t.sent", "t.pos", F.col("t.result").alias("token"), *_offsets(df, tokens)
    )


def _offsets(df: DataFrame, tokens: str) -> list:
    names = df.schema[tokens].dataType.elementType.names
    return [F.col(f"t.{n}").alias(n) for n in ("begin", "end") if n in names]


def to_wide(long: DataFrame, docs: DataFrame, out: str = "words") -> DataFrame:
    """Token lists by document in reading order; documents without tokens keep an empty list."""
    lists = long.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("sent", "pos", "token")))["token"].alias(out)
    )
    return (
        docs.select("doc_id")
        .join(lists, "doc_id", "left")
        .withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
    )


def finish(df: DataFrame, tokens: str = "tokens", out: str = "finished") -> DataFrame:
    """Annotations to plain strings."""
    return df.withColumn(out, F.col(f"{tokens}.result"))


def map_tokens(df: DataFrame, edits: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Replace tokens by position. ``edits`` is ``(doc_id, i, value)``, ``i`` counting all
    tokens of the document from 0. Only the edits are regrouped; a document's tokens move
    once, with its row. The edits stem from ``df`` itself, so they are stored: otherwise
    each further step would compute everything before it twice."""
    edits = materialize(edits, "edits")
    lists = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("i", "value"))).alias("_edits"))
    return (
        df.join(lists, "doc_id", "left")
        .withColumn(tokens, X.apply_edits(F.col(tokens), F.col("_edits")))
        .drop("_edits")
    )
