"""One extreme row: time has to stay linear in its length, and nothing may crash."""

import random
import time

from pyspark.sql import functions as F

from opinia.functions import text as X
from opinia.operators import joins, spell, tokens
from opinia.session import Scope, materialize


def seconds(action):
    start = time.time()
    action()
    return time.time() - start


def test_hyphen_chain_is_one_token(spark):
    docs = spark.createDataFrame([(1, "-".join("a" * 100_000))], "doc_id long, text string")
    assert [len(r["token"]) for r in tokens.sentence_tokens(docs).collect()] == [199_999]


def test_runs_of_blanks(spark):
    text = "a" + " " * 200_000 + "b" + " " * 200_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = []
    took = seconds(lambda: found.append(tokens.tokenize_ws(docs).select(F.size("words")).first()[0]))
    took += seconds(lambda: found.append(tokens.assemble(docs).select(F.length(F.col("document")[0]["result"])).first()[0]))
    assert found == [200_001, 200_002] and took < 30


def test_trim_set_is_white_space(spark):
    blanks = spark.createDataFrame([(1, " \t\n\x0b\f\rx  \t\n\x0b\f\r")], "doc_id long, text string")
    assert tokens.assemble(blanks).first()["document"][0]["result"] == "x "


def test_long_tokens_meet_by_blocks(spark):
    word = "".join(chr(97 + i * 7 % 26) for i in range(100_000))
    odd = [word[:-1], word[:50_000] + "Z" + word[50_000:], word[:10] + "Z" + word[11:], word[1] + word[0] + word[2:], word[2:], word]
    suspects = spark.createDataFrame([(t, 1) for t in odd], "token string, n long")
    dictionary = spark.createDataFrame([(word, 5)], "word string, freq long")
    found = {}
    took = seconds(lambda: found.update({r["token"]: r["candidate"] for r in spell.candidates(suspects, dictionary).collect()}))
    assert found == {t: word for t in odd[:4]} and took < 60


def test_tokens_with_a_long_part_in_common(spark):
    """Half of each word is the same in all of them; none is near another, and no key is shared."""
    rng = random.Random(6)
    stem = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30))
    words = [stem + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30)) for _ in range(8000)]
    suspects = spark.createDataFrame([(w, 1) for w in words[:4000]], "token string, n long")
    dictionary = spark.createDataFrame([(w, 5) for w in words[4000:]], "word string, freq long")
    found = []
    assert seconds(lambda: found.extend(spell.candidates(suspects, dictionary).collect())) < 60 and not found
    # At two edits the common segments are verified pair by pair, in slices.
    assert seconds(lambda: found.extend(spell.candidates(suspects, dictionary, 2).collect())) < 90 and not found


def test_keys_are_shared_by_near_words_only(spark):
    """Words that differ in the middle only, between long equal parts."""
    rng = random.Random(7)
    head, tail = "h" * 45 + "xyz" * 10, "qrs" * 20
    middles = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(1500)]
    frame = lambda ms, names: spark.createDataFrame([(head + m + tail, 5) for m in sorted(set(ms))], names)
    near = [m[:2] + "K" + m[2:] for m in middles[:50]]
    found = spell.candidates(frame(near + middles[700:], "token string, n long"), frame(middles[:700], "word string, freq long"))
    pairs = {(r["token"], r["candidate"]) for r in found.collect()}
    assert {(head + n + tail, head + m + tail) for n, m in zip(near, middles)} <= pairs and len(pairs) < 200
    left = X.edit_keys(F.col("token"), True, True)
    odd = frame(middles[700:], "token string, n long").select(F.explode(left).alias("key"))
    known = frame(middles[:700], "token string, n long").select(F.explode(X.edit_keys(F.col("token"), False, True)).alias("key"))
    assert odd.join(known, "key").count() < 400


def test_patterns_and_blocks_agree_at_the_borders(spark):
    rows = []
    square = X.LONG_TOKEN * X.LONG_TOKEN
    for size in [*range(X.LONG_TOKEN - 2, X.LONG_TOKEN + 4), 95, 96, 97, 98, 145, square - 1, square, square + 1, square + 60]:
        word = "".join(chr(97 + i * 5 % 26) for i in range(size))
        rows.append((word, word[:20] + "Z" + word[20:]))
        rows.append((word, word[:30] + word[31:]))
        rows.append((word, word[:5] + word[6] + word[5] + word[7:]))
        rows.append((word, word[:-2] + "Z" + word[-1]))
        # At the edges of blocks, and at both ends.
        for at in (0, 46, 47, 48, 49, size - 2):
            if at + 1 < size:
                rows.append((word, word[:at] + "Z" + word[at:]))
                rows.append((word, word[:at] + word[at + 1 :]))
                rows.append((word, word[:at] + word[at + 1] + word[at] + word[at + 2 :]))
        rows.append((word, word + "Z"))
    suspects = spark.createDataFrame([(s, 1) for s in {s for _, s in rows}], "token string, n long")
    dictionary = spark.createDataFrame([(w, 5) for w in {w for w, _ in rows}], "word string, freq long")
    found = [(r["candidate"], r["token"]) for r in spell.candidates(suspects, dictionary).collect()]
    assert len(found) == len(set(found)) and set(rows) <= set(found)


def test_lookups_are_bounded_in_bytes(spark):
    wide = spark.createDataFrame([("x" * 3_000_000,)], "token string")
    assert joins.fits(wide) and not joins.fits(wide, max_bytes=1 << 20) and not joins.fits(wide, max_rows=0)


def test_pairs_that_training_never_saw_are_sliced(spark):
    rows = [(i, "new" if i % 2 else f"t{i}") for i in range(4000)]
    left = spark.createDataFrame(rows, "doc_id long, token string")
    lookup = materialize(spark.createDataFrame([(f"t{i}", i) for i in range(4000)], "token string, v long"), "lookup")
    joined = joins.lookup_join(left, lookup, ["token"], "left", ["doc_id"], max_broadcast=10)
    assert "_slice" in joined._jdf.queryExecution().optimizedPlan().toString() and joined.count() == 4000


def test_a_scope_removes_its_tables(spark, tmp_path):
    with Scope(spark) as scope:
        assert materialize(spark.range(3), "three").count() == 3
        paths = list(scope.paths)
    from pathlib import Path

    assert paths and not any(Path(p.removeprefix("file:")).exists() for p in paths)
