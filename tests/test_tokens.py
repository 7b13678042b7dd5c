import pytest
from helpers import by_doc
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from opinia.functions import lists
from opinia.functions import text as X
from opinia.operators import stopwords, terms, tokens


def test_ws_tokens_keep_inner_empties(reviews):
    words = by_doc(tokens.tokenize_ws(reviews), "words")
    assert words[5] == [""]
    assert words[4] == ["", "", "two", "", "spaces", "", "and", "a", "co-op"]
    assert words[1] == ["crust", "is", "not", "good."]


def test_ws_tokens_without_empties(reviews):
    words = by_doc(tokens.tokenize_ws(reviews, drop_empty=True), "words")
    assert words[5] == [] and words[4] == ["two", "spaces", "and", "a", "co-op"]


def test_ws_tokens_equal_the_ml_stage(spark, reviews):
    extra = spark.createDataFrame([(20, "  ", 0.0), (21, "a\tb\n c  ", 0.0)], reviews.schema)
    docs = reviews.unionByName(extra)
    expected = by_doc(Tokenizer(inputCol="text", outputCol="words").transform(docs), "words")
    assert by_doc(tokens.tokenize_ws(docs), "words") == expected


@pytest.mark.parametrize("pattern,gap", [(X.WORDS, r"\W"), (X.TOKENS, "[^a-zA-Z0-9_']")])
def test_regex_tokens_equal_the_ml_stage(reviews, pattern, gap):
    stage = RegexTokenizer(inputCol="text", outputCol="words", pattern=gap)
    expected = by_doc(stage.transform(reviews), "words")
    assert by_doc(tokens.tokenize_regex(reviews, pattern=pattern), "words") == expected
    assert by_doc(tokens.tokenize_regex(reviews, pattern=gap, gaps=True), "words") == expected


def test_regex_tokens_ascii_and_unicode(reviews):
    assert by_doc(tokens.tokenize_regex(reviews), "words")[7] == ["cr", "me", "br", "l", "e", "under_score"]
    unicode = by_doc(tokens.tokenize_regex(reviews, unicode=True), "words")
    assert unicode[7] == ["crème", "brûlée", "under_score"]
    assert by_doc(tokens.tokenize_regex(reviews, min_length=3), "words")[7] == ["under_score"]


def test_token_count_is_an_integer(reviews):
    counted = tokens.token_count(tokens.tokenize_regex(reviews))
    assert counted.schema["tokens"].dataType.simpleString() == "int"
    assert by_doc(counted, "tokens")[8] == 3 and by_doc(counted, "tokens")[5] == 0


def test_stop_words_equal_the_ml_stage(reviews):
    words = tokens.tokenize_regex(reviews)
    for stop in (lists.default_stop_words(), lists.CUSTOM_STOP_WORDS):
        stage = StopWordsRemover(inputCol="words", outputCol="cleaned", stopWords=stop)
        expected = by_doc(stage.transform(words), "cleaned")
        assert by_doc(stopwords.remove_stop_words(words, stop=stop), "cleaned") == expected


def test_negation_survives_only_when_kept(reviews):
    words = tokens.tokenize_regex(reviews)
    assert by_doc(stopwords.remove_stop_words(words), "cleaned")[1] == ["crust", "good"]
    kept = stopwords.remove_stop_words(words, keep=lists.NEGATIONS)
    assert by_doc(kept, "cleaned")[1] == ["crust", "not", "good"]


def test_custom_list_matches_any_case():
    assert len(lists.CUSTOM_STOP_WORDS) == 42 and "I" in lists.CUSTOM_STOP_WORDS
    assert "i" in [w.lower() for w in lists.CUSTOM_STOP_WORDS]


def test_stop_list_is_the_same_with_and_without_a_session(spark, monkeypatch):
    from pyspark import SparkContext

    running = lists.default_stop_words()
    monkeypatch.setattr(SparkContext, "_active_spark_context", None)
    assert sorted(lists.default_stop_words()) == sorted(running) and len(running) == 181


@pytest.mark.parametrize("n", [2, 3])
def test_ngrams_equal_the_ml_stage(reviews, n):
    words = tokens.tokenize_regex(reviews)
    expected = by_doc(NGram(n=n, inputCol="words", outputCol="bigrams").transform(words), "bigrams")
    found = by_doc(terms.ngrams(words, n=n), "bigrams")
    assert found == expected and found[9] == []


def test_sentences(reviews):
    rows = tokens.sentences(reviews).where("doc_id in (2, 5)").orderBy("doc_id", "sent").collect()
    assert [(r["sent"], r["sentence"]) for r in rows] == [(0, "Wow..."), (1, "Loved this place!")]


def test_rule_tokens_keep_case_and_marks(reviews):
    rows = tokens.sentence_tokens(reviews).where("doc_id in (2, 3)").orderBy("doc_id", "sent", "pos").collect()
    assert [r["token"] for r in rows] == [
        "Wow", "...", "Loved", "this", "place", "!",
        "The", "ravoli", "was", "overpriced", ",", "isn't", "it", "?",
    ]


def test_assemble_treats_null_as_empty(raw):
    documents = by_doc(tokens.assemble(raw), "document")
    assert documents[6][0].asDict() == {"result": "", "begin": 0, "end": -1, "sent": 0}
    assert documents[4][0]["result"] == "Two  spaces  and a co-op"
    assert by_doc(tokens.assemble(raw, trim=False), "document")[4][0]["result"].startswith("  Two")


def test_annotations(reviews):
    finished = by_doc(tokens.finish(tokens.annotate(reviews)), "finished")
    assert finished[1] == ["crust", "is", "not", "good"]
    assert finished[3] == ["the", "ravoli", "was", "overpriced", "isn't", "it"]
    assert finished[5] == []
    cased = by_doc(tokens.finish(tokens.annotate(reviews, lowercase=False)), "finished")
    assert cased[8] == ["Good", "good", "GOOD"]
    hyphen = by_doc(tokens.finish(tokens.annotate(reviews, keep_hyphen=True)), "finished")
    assert "co-op" in hyphen[4] and "co-op" not in finished[4]


def test_offsets_point_at_the_token(reviews):
    for lowercase in (True, False):
        long = tokens.token_table(reviews, lowercase=lowercase, offsets=True)
        texts = by_doc(reviews, "text")
        rows = long.collect()
        assert len(rows) == tokens.token_table(reviews).count() > 20
        for r in rows:
            piece = texts[r["doc_id"]][r["begin"] : r["end"] + 1]
            assert (piece.lower() if lowercase else piece) == r["token"]


def test_offsets_need_a_character_class(reviews):
    with pytest.raises(ValueError):
        tokens.token_table(reviews, pattern=r"\w+", offsets=True)


def test_wide_and_long_are_inverse(reviews):
    annotated = tokens.annotate(reviews)
    long = tokens.to_long(annotated)
    assert sorted(long.collect()) == sorted(tokens.token_table(reviews).collect())
    wide = tokens.to_wide(long.repartition(7), reviews)
    assert by_doc(wide, "words") == by_doc(tokens.finish(annotated), "finished")


def test_edits_replace_by_position(spark, reviews):
    annotated = tokens.annotate(reviews)
    edits = spark.createDataFrame([(3, 5, "E"), (3, 0, "A"), (8, 1, "B")], "doc_id long, i int, value string")
    words = by_doc(tokens.finish(tokens.map_tokens(annotated, edits)), "finished")
    assert words[3] == ["A", "ravoli", "was", "overpriced", "isn't", "E"]
    assert words[8] == ["good", "B", "good"] and words[1] == ["crust", "is", "not", "good"]
    assert words[5] == []


def test_stop_table_broadcasts_and_keeps(spark, reviews):
    stop = spark.createDataFrame([("The",), ("is",), ("was",), ("it",), ("not",), (None,)], "word string")
    long = tokens.token_table(reviews)
    left = stopwords.remove_stop_table(long, stop)
    assert [r["token"] for r in left.where("doc_id = 1").orderBy("pos").collect()] == ["crust", "not", "good"]
    assert "BroadcastHashJoin" in left._jdf.queryExecution().executedPlan().toString()
    assert left.where(F.col("token").isin("the", "is", "was", "it")).count() == 0
