"""The cleaning operators as Spark ML pipeline stages.

Each stage is a thin wrapper that names columns; the work is in the operator modules. Rows
are identified by ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.functions import lists
from opinia.operators import lemma, spell, stopwords, terms, tokens
from opinia.session import materialize


def _words(df: DataFrame, column: str) -> DataFrame:
    """Term statistics of an annotation column, stored."""
    listed = df.select("doc_id", F.col(f"{column}.result").alias("words"))
    return materialize(terms.term_stats(listed), "words")


class Annotate(Transformer):
    """Text to sentence-wise token annotations."""

    def __init__(self, output: str = "tokens", **options):
        super().__init__()
        self.output, self.options = output, options

    def _transform(self, df: DataFrame) -> DataFrame:
        return tokens.annotate(df, self.output, **self.options)


class SpellCheck(Estimator):
    """Learns what a spelling correction needs from the documents it is fitted on.

    ``context=False`` corrects each token on its own, ``context=True`` by its neighbours.
    ``dictionary`` is ``(word, freq)``; without it, frequent tokens serve.
    """

    def __init__(
        self,
        context: bool = True,
        dictionary: DataFrame | None = None,
        min_count: int = 5,
        max_distance: int = 1,
        column: str = "tokens",
    ):
        super().__init__()
        self.context, self.dictionary = context, dictionary
        self.min_count, self.max_distance, self.column = min_count, max_distance, column

    def _fit(self, df: DataFrame) -> SpellCheckModel:
        words = _words(df, self.column)
        known = self.dictionary
        if known is None:
            known = spell.corpus_dictionary(words, self.min_count)
        bigrams = None
        if self.context:
            bigrams = materialize(spell.bigram_lm(df, self.column), "bigrams")
        return SpellCheckModel(words, known, bigrams, self.max_distance, self.column)


class SpellCheckModel(Model):
    """Corrects the tokens of any documents that the learned dictionary lacks."""

    def __init__(
        self,
        words: DataFrame,
        dictionary: DataFrame,
        bigrams: DataFrame | None,
        max_distance: int,
        column: str,
    ):
        super().__init__()
        self.words, self.dictionary, self.bigrams = words, dictionary, bigrams
        self.max_distance, self.column = max_distance, column

    def _transform(self, df: DataFrame) -> DataFrame:
        here = _words(df, self.column)
        odd = spell.suspects(here, self.dictionary)
        cands = materialize(
            spell.candidates(odd, self.dictionary, self.max_distance), "candidates"
        )
        if self.bigrams is None:
            fixes = materialize(spell.best_candidates(cands), "corrections")
            return spell.correct_wide(df, fixes, self.column, here)
        fixed = spell.correct_in_context(
            df, self.words, self.bigrams, cands, self.column, counts=here
        )
        return spell.correct_in_context_wide(df, fixed, self.column)


class Lemmatize(Estimator):
    """Dictionary lemmatizer; without a ``(form, lemma)`` table one is derived when fitted."""

    def __init__(self, lemmas: DataFrame | None = None, column: str = "tokens"):
        super().__init__()
        self.lemmas, self.column = lemmas, column

    def _fit(self, df: DataFrame) -> LemmatizeModel:
        table = self.lemmas
        if table is None:
            table = materialize(lemma.derive_lemmas(_words(df, self.column)), "lemmas")
        return LemmatizeModel(table, self.column)


class LemmatizeModel(Model):
    def __init__(self, lemmas: DataFrame, column: str):
        super().__init__()
        self.lemmas, self.column = lemmas, column

    def _transform(self, df: DataFrame) -> DataFrame:
        return lemma.lemmatize_wide(df, self.lemmas, self.column)


class DropStopWords(Transformer):
    """Stop-word removal on annotations, sparing the words in ``keep``."""

    def __init__(self, stop: Iterable[str], keep: Iterable[str] = (), column: str = "tokens"):
        super().__init__()
        self.stop, self.keep, self.column = list(stop), list(keep), column

    def _transform(self, df: DataFrame) -> DataFrame:
        return stopwords.drop_annotated(df, self.column, self.stop, self.keep)


class Finish(Transformer):
    """Annotations to plain strings."""

    def __init__(self, column: str = "tokens", output: str = "finished"):
        super().__init__()
        self.column, self.output = column, output

    def _transform(self, df: DataFrame) -> DataFrame:
        return tokens.finish(df, self.column, self.output)


class StableCountVectorizer(Estimator):
    """A count vectorizer whose indexes follow ``(count desc, token)`` on any data layout.

    The vocabulary is the only thing that reaches the driver; ``vocab_size`` bounds it.
    """

    def __init__(
        self, input: str = "finished", output: str = "rawFeatures", vocab_size: int = 1 << 18, min_df: int = 1
    ):
        super().__init__()
        self.input, self.output, self.vocab_size, self.min_df = input, output, vocab_size, min_df

    def _fit(self, df: DataFrame) -> CountVectorizerModel:
        stats = terms.term_stats(df.select("doc_id", F.col(self.input).alias("words")))
        ranked = terms.vocabulary(stats, self.vocab_size, self.min_df)
        listed = [r["token"] for r in ranked.orderBy("index").select("token").collect()]
        return CountVectorizerModel.from_vocabulary(listed, self.input, self.output)


def stop_words_of(strategy: str) -> list[str] | None:
    """The stop list of a strategy: ``sw_pre`` (shipped list), ``sw_cstm`` (custom), ``sw_none``."""
    known = {
        "sw_pre": lists.default_stop_words(),
        "sw_cstm": lists.CUSTOM_STOP_WORDS,
        "sw_none": None,
    }
    if strategy not in known:
        raise ValueError(f"unknown strategy {strategy!r}; known: {', '.join(known)}")
    return known[strategy]
