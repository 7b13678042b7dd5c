import math
from collections import Counter

import pytest
from helpers import by_doc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from opinia.operators import joins, terms, tokens
from opinia.operators.features import hashing_tf
from opinia.operators.order import running_sums
from opinia.operators.stages import StableCountVectorizer
from opinia.session import materialize


@pytest.fixture(scope="module")
def words(reviews):
    return tokens.tokenize_regex(reviews).select("doc_id", "words").cache()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "ç", "the"]), max_size=12), min_size=1, max_size=5))
def test_term_counts_against_brute_force(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, words array<string>")
    found = {(r["doc_id"], r["token"]): r["tf"] for r in terms.term_counts(df).collect()}
    assert found == {(i, t): n for i, ws in enumerate(lists) for t, n in Counter(ws).items()}


def test_term_counts_do_not_shuffle(words):
    plan = terms.term_counts(words)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_term_freq_sums_to_one(words):
    sums = terms.term_freq(words).groupBy("doc_id").agg(F.sum("freq").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-12 for r in sums)


def test_idf_values(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "b"]), (2, ["a"]), (3, ["a"])], "doc_id long, words array<string>"
    )
    stats = materialize(terms.term_stats(df), "stats")
    weights = {r["token"]: r["idf"] for r in terms.idf(stats, 3).collect()}
    assert weights["a"] == 0.0 and math.isclose(weights["b"], math.log(2))
    assert {r["token"]: r["idf"] for r in terms.idf(stats, 3, min_df=2).collect()}["b"] == 0.0
    assert {r["token"]: r["n"] for r in stats.collect()} == {"a": 3, "b": 2}


def test_tf_idf_equals_the_ml_stages(words):
    vocabulary = sorted({t for ws in by_doc(words, "words").values() for t in ws})
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "words", "raw").transform(words)
    vectors = IDF(inputCol="raw", outputCol="out").fit(counted).transform(counted)
    expected = {
        (r["doc_id"], vocabulary[i]): x
        for r in vectors.select("doc_id", vector_to_array("out").alias("v")).collect()
        for i, x in enumerate(r["v"])
        if x
    }
    weights = materialize(terms.idf(terms.term_stats(words), words.count()), "weights")
    scored = terms.tf_idf(terms.term_counts(words), weights)
    found = {(r["doc_id"], r["token"]): r["tf_idf"] for r in scored.where("tf_idf <> 0").collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-12) for k in found)


def test_vocabulary_does_not_depend_on_layout(spark):
    rows = [(i, [f"t{(i * 7) % 13}", f"t{i % 5}", "x"]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, words array<string>")
    counts = Counter(t for _, ws in rows for t in ws)
    expected = [t for t, _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))]
    for n in (1, 7):
        found = terms.vocabulary(terms.term_stats(df.repartition(n)), vocab_size=9).orderBy("index").collect()
        assert [r["token"] for r in found] == expected[:9]
        assert [r["index"] for r in found] == list(range(9))


def test_stable_count_vectorizer(words):
    model = StableCountVectorizer(input="words", vocab_size=4).fit(words)
    assert model.vocabulary[:1] == ["good"] and len(model.vocabulary) == 4
    assert model.transform(words).count() == 9


def test_running_sums_against_a_plain_loop(spark):
    rows = [((i * 37) % 101, i % 4) for i in range(101)]
    df = spark.createDataFrame(rows, "k int, v int")
    found = {r["k"]: r["s"] for r in running_sums(df, [F.asc("k")], {"v": "s"}, "test").collect()}
    total, expected = 0, {}
    for k, v in sorted(rows):
        expected[k] = total
        total += v
    assert found == expected


def test_hashed_mass_is_the_token_count(words):
    hashed = hashing_tf(words, num_features=20)
    mass = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, x: a + x)
    rows = hashed.select(mass.alias("mass"), F.size("words").alias("n")).collect()
    assert all(r["mass"] == r["n"] for r in rows)
    assert HashingTF().getNumFeatures() == 1 << 18


def test_top_terms_and_ngrams(spark):
    df = spark.createDataFrame(
        [(1, 1.0, ["great", "price", "great", "price"]), (2, 0.0, ["tasted", "bad"])],
        "doc_id long, label double, words array<string>",
    )
    assert [r["token"] for r in terms.top_terms(terms.term_stats(df), 2).collect()] == ["great", "price"]
    top = terms.top_ngrams(df, k=1).first()
    assert (top["ngram"], top["n"], top["n_pos"], top["n_neg"], top["pos_share"]) == ("great price", 2, 2, 0, 1.0)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_sliced_join_equals_the_plain_join(spark, how):
    # One key holds more than a third of the rows; one heavy key has no partner.
    rows = [(i, "hot" if i % 5 < 2 else "gone" if i % 5 == 2 else f"k{i % 9}") for i in range(400)]
    left = spark.createDataFrame(rows, "id long, token string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("unused", 4)], "token string, v int")
    counts = materialize(left.groupBy("token").agg(F.count("*").alias("n")), "counts")
    heavy = joins.heavy_keys(counts, ["token"], "n")
    assert {r["token"] for r in heavy.collect()} >= {"hot"}
    found = joins.sliced_join(left, right, ["token"], how, heavy, ["id"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        map(tuple, left.join(right, "token", how).collect()), key=str
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_lookup_join_beyond_the_broadcast_size(spark, how):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(300)]
    left = spark.createDataFrame(rows, "id long, token string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3)], "token string, v int")
    small = joins.lookup_join(left, right, ["token"], how, ["id"])
    large = joins.lookup_join(left, right, ["token"], how, ["id"], max_broadcast=2)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(
        map(tuple, large.select(*small.columns).collect()), key=str
    )


def test_heavy_keys_are_few_and_none_when_even(spark):
    even = spark.createDataFrame([(f"k{i}", 1) for i in range(50)], "token string, n long")
    assert joins.heavy_keys(even, ["token"], "n") is None
    uneven = spark.createDataFrame([("a", 100), ("b", 90), ("c", 1)], "token string, n long")
    found = {r["token"]: r["_slices"] for r in joins.heavy_keys(uneven, ["token"], "n").collect()}
    assert set(found) == {"a", "b"} and sum(found.values()) <= 2 * 4


def test_term_stats_need_no_function_of_each_token(spark, capsys):
    rows = [(1, ["b", "a", "b"]), (2, ["a"]), (3, []), (4, None), (5, ["", "a", ""])]
    found = terms.term_stats(spark.createDataFrame(rows, "doc_id long, words array<string>"))
    found.explain()
    assert "lambda" not in capsys.readouterr().out
    assert {r["token"]: (r["df"], r["n"]) for r in found.collect()} == {"a": (3, 3), "b": (1, 2), "": (1, 2)}
