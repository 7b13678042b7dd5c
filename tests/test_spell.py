import itertools
import random

import pytest
from helpers import by_doc
from pyspark.sql import functions as F

from opinia.functions import text as X
from opinia.operators import lemma, spell, terms, tokens
from opinia.operators.stages import Finish, Lemmatize, SpellCheck
from opinia.session import materialize

DICTIONARY = [
    ("loved", 50), ("moved", 90), ("ravioli", 7), ("overpriced", 12), ("place", 80), ("crust", 9), ("good", 99),
]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "word string, freq long")


def one_edit(a: str, b: str, swaps: bool) -> bool:
    """By definition: one insertion, deletion, substitution or swap of neighbours apart."""
    if a == b:
        return False
    letters = sorted(set(a + b))
    reached = {a[:i] + a[i + 1 :] for i in range(len(a))}
    reached |= {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    reached |= {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in letters}
    if swaps:
        reached |= {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
    return b in reached


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def made_up(spark):
    """Short words over three letters collide often; a few are longer than the key limit."""
    rng = random.Random(7)
    pool = sorted({"".join(rng.choice("abç") for _ in range(rng.randint(1, 6))) for _ in range(160)})
    long = "ab" * 30
    odd = pool[::2] + [long + "b", long[:20] + "ç" + long[21:], "b" + long[2:]]
    known = pool[1::2] + [long]
    return odd, known


@pytest.mark.parametrize("swaps", [True, False])
def test_candidates_against_brute_force(spark, made_up, swaps):
    odd, known = made_up
    found = spell.candidates(
        spark.createDataFrame([(t,) for t in odd], "token string"),
        spark.createDataFrame([(w, len(w)) for w in known], "word string, freq long"),
        transpositions=swaps,
    ).collect()
    pairs = [(r["token"], r["candidate"]) for r in found]
    expected = {(a, b) for a, b in itertools.product(odd, known) if one_edit(a, b, swaps)}
    assert len(pairs) == len(set(pairs)), "each pair is produced once"
    assert set(pairs) == expected and len(expected) > 100
    assert any(len(a) > X.LONG_TOKEN for a, _ in expected)


def test_candidates_at_distance_two(spark, made_up):
    odd, known = (ws[:40] for ws in made_up)
    found = spell.candidates(
        spark.createDataFrame([(t,) for t in odd], "token string"),
        spark.createDataFrame([(w, 1) for w in known], "word string, freq long"),
        max_distance=2,
        transpositions=False,
    ).collect()
    expected = {
        (a, b, levenshtein(a, b)) for a, b in itertools.product(odd, known) if levenshtein(a, b) <= 2
    }
    assert sorted((r["token"], r["candidate"], r["distance"]) for r in found) == sorted(expected)


@pytest.mark.parametrize("swaps", [False, True])
def test_distance_two_against_brute_force(spark, swaps):
    """Around the length from which pairs meet by segments, and at long words."""
    rng = random.Random(21)
    known, odd = [], []
    for size in [3, 4, 5, 13, 14, 15, 16, 17, 18, 19, 20, 33, 60, 120]:
        for _ in range(4):
            word = "".join(rng.choice("abc") for _ in range(size))
            known.append(word)
            for edits in (0, 1, 2, 3):
                other = list(word)
                for _ in range(edits):
                    at = rng.randrange(len(other)) if other else 0
                    kind = rng.choice("ids")
                    if kind == "i":
                        other.insert(at, rng.choice("abcd"))
                    elif kind == "d" and len(other) > 1:
                        del other[at]
                    else:
                        other[at] = rng.choice("abcd")
                odd.append("".join(other))
            odd.append(word[1:2] + word[:1] + word[2:])
    known, odd = sorted(set(known)), sorted(set(odd))
    found = spell.candidates(
        spark.createDataFrame([(t,) for t in odd], "token string"),
        spark.createDataFrame([(w, 1) for w in known], "word string, freq long"),
        max_distance=2,
        transpositions=swaps,
    ).collect()
    expected = {
        (a, b): 1 if swaps and one_edit(a, b, True) else levenshtein(a, b)
        for a, b in itertools.product(odd, known) if levenshtein(a, b) <= 2
    }
    assert len(found) == len({(r["token"], r["candidate"]) for r in found})
    assert {(r["token"], r["candidate"]): r["distance"] for r in found} == expected


def test_composed_lookups_equal_two_rounds(spark):
    rows = [(1, "the ravoli was goood and cars moved"), (2, "ravoli cars carz"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    annotated = tokens.annotate(docs)
    stats = terms.term_stats(annotated.select("doc_id", F.col("tokens.result").alias("words")))
    fixes = spark.createDataFrame([("ravoli", "ravioli"), ("goood", "goods"), ("carz", "cars")], "token string, corrected string")
    lemmas = spark.createDataFrame([("cars", "car"), ("goods", "good"), ("moved", "move"), ("unseen", "x")], "form string, lemma string")
    once = spell.correct_wide(annotated, spell.compose(stats, fixes, lemmas), "tokens", stats)
    twice = lemma.lemmatize_wide(spell.correct_wide(annotated, fixes), lemmas)
    words = by_doc(tokens.finish(once), "finished")
    assert words == by_doc(tokens.finish(twice), "finished")
    assert words[1] == ["the", "ravioli", "was", "good", "and", "car", "move"] and words[2] == ["ravioli", "car", "car"]


def words_of(spark, rows):
    return spark.createDataFrame(rows, "token string, n long")


def test_dictionary_words_are_never_changed(spark, dictionary):
    words = words_of(spark, [("loved", 1), ("overpriced", 1), ("ravoli", 1), ("cat1x", 1), ("mov", 1)])
    odd = spell.suspects(words, dictionary)
    assert {r["token"] for r in odd.collect()} == {"ravoli"}


def test_golden_corrections(spark, dictionary):
    words = words_of(spark, [("ravoli", 2), ("loved", 3), ("overpriced", 1), ("goood", 1), ("xoved", 1), ("palce", 1)])
    best = spell.best_candidates(spell.candidates(spell.suspects(words, dictionary), dictionary))
    assert {r["token"]: r["corrected"] for r in best.collect()} == {
        "ravoli": "ravioli",
        "goood": "good",
        "xoved": "moved",  # loved is as near, moved more frequent
        "palce": "place",
    }


def test_word_spelling_in_a_pipeline(reviews, dictionary):
    annotated = tokens.annotate(reviews)
    fixed = SpellCheck(context=False, dictionary=dictionary).fit(annotated).transform(annotated)
    words = by_doc(Finish().transform(fixed), "finished")
    assert words[3] == ["the", "ravioli", "was", "overpriced", "isn't", "it"]
    assert words[2] == ["wow", "loved", "this", "place"] and words[5] == []


@pytest.fixture(scope="module")
def corpus(spark):
    """The same misspelling stands where 'loved' is usual and where 'moved' is."""
    lines = ["they loved it."] * 6 + ["we moved out."] * 8 + ["they xoved it. we xoved out", "xoved"]
    return spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")


def test_context_decides_between_candidates(spark, corpus):
    annotated = tokens.annotate(corpus)
    model = SpellCheck(context=True, min_count=5).fit(annotated)
    words = by_doc(Finish().transform(model.transform(annotated)), "finished")
    assert words[14] == ["they", "loved", "it", "we", "moved", "out"]
    assert words[15] == ["moved"]  # no neighbours: nothing but the unigram order is left
    assert words[0] == ["they", "loved", "it"]


def test_context_spelling_corrects_unseen_text(spark, corpus):
    model = SpellCheck(context=True, min_count=5).fit(tokens.annotate(corpus))
    other = tokens.annotate(
        spark.createDataFrame([(1, "They lovd it"), (2, "nothing here")], "doc_id long, text string")
    )
    words = by_doc(Finish().transform(model.transform(other)), "finished")
    assert words == {1: ["they", "loved", "it"], 2: ["nothing", "here"]}


def test_context_spelling_beyond_the_broadcast_size(spark, corpus, monkeypatch):
    annotated = tokens.annotate(corpus)
    stats = materialize(
        terms.term_stats(tokens.finish(annotated, out="words").select("doc_id", "words")), "words"
    )
    known = spell.corpus_dictionary(stats)
    cands = materialize(spell.candidates(spell.suspects(stats, known), known), "cands")
    pairs = materialize(spell.bigram_lm(annotated), "bigrams")

    def run():
        fixed = spell.correct_in_context(annotated, stats, pairs, cands)
        return sorted(map(tuple, fixed.collect()))

    small = run()
    monkeypatch.setattr(spell.lookup_join, "__defaults__", (None, "n", 0))
    assert run() == small and len(small) == 3


def test_neighbours_stay_in_the_sentence(spark):
    df = spark.createDataFrame([(1, "a b. c d")], "doc_id long, text string")
    rows = spell.neighbours(tokens.annotate(df)).orderBy("i").collect()
    assert [(r["prev"], r["token"], r["next"]) for r in rows] == [
        (None, "a", "b"), ("a", "b", None), (None, "c", "d"), ("c", "d", None),
    ]
    counts = spell.bigram_lm(tokens.annotate(df)).collect()
    assert {(r["prev"], r["token"]): r["n"] for r in counts} == {("a", "b"): 1, ("c", "d"): 1}


def test_lemma_table_is_applied(spark):
    table = spark.createDataFrame(
        [("doing", "do"), ("does", "do"), ("did", "do"), ("loved", "love"), ("crusts", "crust")],
        "form string, lemma string",
    )
    df = spark.createDataFrame([(1, "Doing, Does, Did"), (2, "loved crusts"), (3, "")], "doc_id long, text string")
    annotated = tokens.annotate(df)
    long = lemma.lemmatize(tokens.to_long(annotated), table)
    assert [r["lemma"] for r in long.where("doc_id = 1").collect()] == ["do", "do", "do"]
    assert "BroadcastHashJoin" in long._jdf.queryExecution().executedPlan().toString()
    wide = by_doc(Finish().transform(Lemmatize(table).fit(annotated).transform(annotated)), "finished")
    assert wide == {1: ["do", "do", "do"], 2: ["love", "crust"], 3: []}


def test_lemmas_from_the_corpus(spark):
    words = words_of(spark, [("walk", 3), ("walking", 1), ("walks", 1), ("is", 1), ("i", 1), ("ration", 1), ("ra", 1)])
    found = {r["form"]: r["lemma"] for r in lemma.derive_lemmas(words).collect()}
    assert found == {"walking": "walk", "walks": "walk"}


def test_keys_do_not_multiply_inside_a_row(spark):
    df = spark.createDataFrame([("aaaa",)], "token string")
    keys = df.select(X.edit_keys(F.col("token"), True, True).alias("k")).first()["k"]
    # One deletion, the token itself, the token from swapping equal letters, four blanks.
    assert len(keys) == len(set(keys)) == 7


def test_neighbours_are_read_without_a_function_of_each_token(spark, capsys):
    docs = spark.createDataFrame([(1, "one two. three four five"), (2, ""), (3, "six")], "doc_id long, text string")
    stored = materialize(tokens.annotate(docs).select("doc_id", "tokens"), "annotated")
    found = spell.neighbours(stored)
    found.explain()
    assert "lambda" not in capsys.readouterr().out
    rows = sorted((r["doc_id"], r["i"], r["sent"], r["pos"], r["prev"], r["token"], r["next"]) for r in found.collect() if r["i"])
    assert rows[0] == (1, 1, 0, 1, "one", "two", None)
    assert sorted(r["token"] for r in found.collect() if r["prev"] is None) == ["one", "six", "three"]
    assert found.count() == 6
    assert sorted(r["token"] for r in spell.neighbours(stored, min_length=4).collect()) == ["five", "four", "three"]
