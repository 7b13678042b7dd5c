"""Spelling correction without a pretrained model: a dictionary, candidates one edit away,
and, for the context form, the counts of neighbouring words.

Everything up to the choice of a word works on distinct tokens or distinct word pairs, so
the cost follows the vocabulary and not the corpus.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.functions import rows
from opinia.functions import text as X
from opinia.operators.joins import drop_idle, heavy_keys, lookup_join, sliced_join
from opinia.operators.tokens import map_tokens
from opinia.session import materialize


def corpus_dictionary(words: DataFrame, min_count: int = 5, min_length: int = 3) -> DataFrame:
    """``(word, freq)``: tokens seen often enough to be taken as spelled right."""
    return words.where((F.col("n") >= min_count) & (F.length("token") >= min_length)).select(
        F.col("token").alias("word"), F.col("n").alias("freq")
    )


def suspects(words: DataFrame, dictionary: DataFrame, min_length: int = 4) -> DataFrame:
    """``(token, n)`` of the tokens that may be corrected: long enough, no digits, and not in
    the dictionary. A token of the dictionary is never changed."""
    plausible = words.where((F.length("token") >= min_length) & ~F.col("token").rlike("[0-9]"))
    return plausible.join(dictionary.select(F.col("word").alias("token")), "token", "left_anti").select(
        "token", "n"
    )


def candidates(
    odd: DataFrame, dictionary: DataFrame, max_distance: int = 1, transpositions: bool = True
) -> DataFrame:
    """``(token, candidate, distance, freq)``: dictionary words near each suspect.

    Both sides emit keys and are joined on them. At distance 1 a key is shared exactly by what one
    edit separates, so no key is hot and no pair is capped. A swap of two neighbouring letters
    counts as one edit. At distance 2 short words meet by deletions, and long ones by segments,
    of which many words can have the same; a key that holds more than its share of the pairs is cut into
    slices, and pairs are verified by a mask of their letter pairs first, and then in time linear in their
    length.
    """
    longest = dictionary.agg(F.max(F.length("word"))).first()[0] or 0
    # A longer suspect has no partner, whatever the dictionary holds.
    odd = odd.where(F.length("token") <= longest + max_distance)
    words = dictionary.select(F.col("word").alias("candidate"), "freq")
    if max_distance == 1:
        return _one_edit(odd, words, transpositions)
    near = _by_deletions(odd, words, max_distance).unionByName(_by_segments(odd, words, max_distance))
    if transpositions:
        near = near.unionByName(_one_edit(odd, words, True))
    # A pair can meet by several keys.
    return near.groupBy("token", "candidate").agg(F.min("distance").alias("distance"), F.max("freq").alias("freq"))


def _one_edit(odd: DataFrame, words: DataFrame, transpositions: bool) -> DataFrame:
    left = rows.explode(odd, ["token"], X.edit_keys(F.col("token"), True, transpositions), "key")
    right = rows.explode(
        words, ["candidate", "freq"], X.edit_keys(F.col("candidate"), False, transpositions), "key"
    )
    # The optimizer does not see that the keys multiply the rows, and would broadcast them.
    pairs = left.join(right.hint("merge"), "key")
    a, b = F.col("token"), F.col("candidate")
    # Long pairs meet by digests, and maybe by several.
    checked = X.met_once(F.col("key"), a, b) & X.one_edit(a, b, transpositions)
    return pairs.where(~X.met_by_block(F.col("key")) | checked).select(
        "token", "candidate", F.lit(1).alias("distance"), "freq"
    )


def _verified(pairs: DataFrame, max_distance: int) -> DataFrame:
    return (
        pairs.withColumn("distance", F.levenshtein("token", "candidate", max_distance))
        .where(F.col("distance") >= 0)
        .select("token", "candidate", "distance", "freq")
    )


def _by_deletions(odd: DataFrame, words: DataFrame, edits: int) -> DataFrame:
    """Pairs in which neither token is longer than ``SHORT_TOKEN``."""
    left = rows.explode(
        odd.where(F.length("token") <= X.SHORT_TOKEN), ["token"], X.delete_keys(F.col("token"), edits), "key"
    )
    right = rows.explode(
        words.where(F.length("candidate") <= X.SHORT_TOKEN), ["candidate", "freq"], X.delete_keys(F.col("candidate"), edits), "key"
    )
    # At most two edits apart, and so are their lengths.
    fits = F.abs(F.length("token") - F.length("candidate")) <= edits
    return _verified(left.join(right.hint("merge"), "key").where(fits), edits)


def _by_segments(odd: DataFrame, words: DataFrame, edits: int) -> DataFrame:
    """Pairs in which a token is longer than ``SHORT_TOKEN``."""
    odd = odd.withColumn("odd_mask", X.bigram_mask(F.col("token")))
    words = words.withColumn("mask", X.bigram_mask(F.col("candidate")))
    left = rows.explode(odd, ["token", "odd_mask"], X.segment_keys(F.col("token"), True, edits), "key")
    right = rows.explode(words, ["candidate", "freq", "mask"], X.segment_keys(F.col("candidate"), False, edits), "key")
    left, right = materialize(left, "suspect-segments"), materialize(right, "word-segments")
    # A key is as heavy as the pairs that it makes.
    a = left.groupBy("key").agg(F.count("*").alias("a"))
    b = right.groupBy("key").agg(F.count("*").alias("b"))
    pairs = materialize(a.join(b.hint("merge"), "key").select("key", (F.col("a") * F.col("b")).alias("n")), "segment-pairs")
    heavy = heavy_keys(pairs, ["key"], "n")
    if heavy is None:
        met = left.join(right.hint("merge"), "key")
    else:
        met = sliced_join(left, right, ["key"], "inner", heavy, ["token"])
    # Most pairs that only have a segment in common are told apart by two numbers.
    near = F.bit_count(F.col("odd_mask").bitwiseXOR(F.col("mask"))) <= 4 * edits
    return _verified(met.where(near), edits)


def best_candidates(cands: DataFrame) -> DataFrame:
    """``(token, corrected, distance, freq)``: nearest, then most frequent, then smallest."""
    best = F.min(F.struct("distance", (-F.col("freq")).alias("minus_freq"), "candidate"))
    return (
        cands.groupBy("token")
        .agg(best.alias("best"))
        .select(
            "token",
            F.col("best.candidate").alias("corrected"),
            F.col("best.distance").alias("distance"),
            (-F.col("best.minus_freq")).alias("freq"),
        )
    )


def compose(words: DataFrame, corrections: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(token, corrected, n)``: what becomes of each distinct token that a correction, and then a
    lemma, change in the end; so that a text needs one lookup and is edited once.

    ``words`` is ``(token, n, ...)``, ``corrections`` ``(token, corrected)``, ``lemmas`` ``(form, lemma)``.
    """
    spelled = words.select("token", "n").join(corrections.select("token", "corrected"), "token", "left")
    spelled = spelled.withColumn("form", F.coalesce("corrected", "token")).drop("corrected")
    ends = lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
    both = spelled.join(ends, "form", "left").withColumn("corrected", F.coalesce("lemma", "form"))
    return materialize(both.where(F.col("corrected") != F.col("token")).select("token", "corrected", "n"), "composed")


def correct_wide(
    df: DataFrame, corrections: DataFrame, tokens: str = "tokens", counts: DataFrame | None = None
) -> DataFrame:
    """Apply ``(token, corrected)`` to an annotation array. ``counts (token, n)`` are the term
    statistics of ``df``."""
    places = rows.posexplode(df, ["doc_id"], f"{tokens}.result", "i", "token")
    if counts is not None:
        places = drop_idle(places, counts, corrections, "token")
    hits = lookup_join(
        places, corrections.select("token", "corrected"), ["token"], "inner", ["doc_id", "i"], counts
    )
    return map_tokens(df, hits.select("doc_id", "i", F.col("corrected").alias("value")), tokens)


def neighbours(df: DataFrame, tokens: str = "tokens", min_length: int = 0) -> DataFrame:
    """``(doc_id, i, sent, pos, prev, token, next)``: each token of some length with its
    neighbours in the same sentence, read from the array, so no window is needed."""

    # Shifted lists beside each other; a function of each element would run outside generated code.
    words, sents = F.col(f"{tokens}.result"), F.col(f"{tokens}.sent")
    shifted = lambda values, kind: F.concat(F.array(F.lit(None).cast(kind)), values)
    following = lambda values: F.slice(values, 2, F.greatest(F.size(values), F.lit(0)))
    lists = {
        "token": words,
        "sent": sents,
        "pos": F.col(f"{tokens}.pos"),
        "_prev": shifted(words, "string"),
        "_prev_sent": shifted(sents, "int"),
        "_next": following(words),
        "_next_sent": following(sents),
    }
    zipped = F.arrays_zip(*[values.alias(name) for name, values in lists.items()])
    places = df.select("doc_id", F.posexplode_outer(zipped).alias("i", "_t")).select("doc_id", "i", "_t.*")
    # The lists that begin with null are longer by one.
    return places.where(F.col("token").isNotNull() & (F.length("token") >= min_length)).select(
        "doc_id",
        "i",
        "sent",
        "pos",
        F.when(F.col("_prev_sent") == F.col("sent"), F.col("_prev")).alias("prev"),
        "token",
        F.when(F.col("_next_sent") == F.col("sent"), F.col("_next")).alias("next"),
    )


def bigram_lm(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(prev, token, n)``: counts of neighbouring words inside a sentence."""
    pairs = neighbours(df, tokens).where(F.col("prev").isNotNull())
    return pairs.groupBy("prev", "token").agg(F.count("*").alias("n"))


def correct_in_context(
    df: DataFrame,
    words: DataFrame,
    bigrams: DataFrame,
    cands: DataFrame,
    tokens: str = "tokens",
    distance_weight: float = 1.0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``(doc_id, i, sent, pos, token, corrected)`` for every occurrence of a suspect.

    A candidate scores ``ln(c(prev, cand) + 1) + ln((c(cand, next) + 1) / (c(cand) + V))``
    minus ``distance_weight`` per edit; the factor ``c(prev) + V`` of the usual smoothed form
    is the same for all candidates of one place and is left out. A missing neighbour adds
    nothing. Ties go to the more frequent, then to the smaller word.

    The three lookups are per token and per word pair: all candidates of a token, those that
    were seen after ``prev``, those seen before ``next``. Only pairs that were seen are
    stored. ``words`` and ``bigrams`` are what the model was learned from, ``counts`` the
    term statistics of ``df`` where that is another text. All of them, and ``cands``, should
    be stored tables. Pairs are spread by how often ``df`` itself has them, which the model
    need not know.
    """
    counts = words if counts is None else counts
    vocab = words.count()
    seen = words.select(F.col("token").alias("candidate"), F.col("n").alias("c"))
    listed = materialize(
        cands.join(seen, "candidate", "left")
        .groupBy("token")
        .agg(
            F.collect_list(
                F.struct("candidate", "distance", "freq", F.coalesce("c", F.lit(0)).alias("c"))
            ).alias("cands")
        ),
        "listed",
    )
    pairs = cands.select("token", "candidate")
    # Rows per suspect: a caller's dictionary can make a frequent token a suspect.
    odd = counts.join(pairs.select("token").distinct(), "token", "left_semi").select("token", "n")
    odd = materialize(odd, "suspect-counts")
    followed = bigrams.select(F.col("prev").alias("token"), F.col("token").alias("next"), "n")
    # Neither reads the other, and both are many small steps.
    with ThreadPool(2) as pool:
        seen_after, seen_before = pool.starmap(
            inheritable_thread_target(df.sparkSession)(_seen),
            [(bigrams, "prev", pairs, odd, "after"), (followed, "next", pairs, odd, "before")],
        )
    shortest = pairs.agg(F.min(F.length("token"))).first()[0] or 0
    # Most occurrences are of frequent tokens that are no suspects; they go before anything moves.
    suspected = drop_idle(neighbours(df, tokens, shortest), counts, odd, "token")
    # Stored, as the occurrences of suspects are counted by pair and then joined twice.
    found = materialize(lookup_join(suspected, odd.select("token"), ["token"], "inner", ["doc_id", "i"], odd), "places")
    places = lookup_join(found, listed, ["token"], "inner", ["doc_id", "i"], odd)
    for seen, on in ((seen_after, ["prev", "token"]), (seen_before, ["token", "next"])):
        by_pair = materialize(found.groupBy(*on).agg(F.count("*").alias("n")), "pair-counts")
        places = lookup_join(places, seen, on, "left", ["doc_id", "i"], by_pair)

    def count_in(seen, word):
        return F.coalesce(F.try_element_at(F.col(seen), word), F.lit(0))

    def scored(cand):
        left = F.when(F.col("prev").isNull(), 0.0).otherwise(F.log(count_in("after", cand["candidate"]) + 1.0))
        right = F.when(F.col("next").isNull(), 0.0).otherwise(
            F.log((count_in("before", cand["candidate"]) + 1.0) / (cand["c"] + F.lit(float(vocab))))
        )
        score = F.round(left + right - F.lit(distance_weight) * cand["distance"], 9)
        return F.struct((-score).alias("s"), (-cand["freq"]).alias("f"), cand["candidate"].alias("w"))

    best = F.array_min(F.transform("cands", scored))["w"]
    return places.select("doc_id", "i", "sent", "pos", "token", best.alias("corrected"))


def _seen(
    bigrams: DataFrame, side: str, pairs: DataFrame, odd: DataFrame, out: str
) -> DataFrame:
    """``(token, side, out)``: for each suspect and each word seen on one side of it, which of
    its candidates were seen next to that word, and how often. ``bigrams`` is
    ``(token, side, n)``, ``pairs`` ``(token, candidate)``, ``odd`` the rows per suspect.

    Stored, since it is read for its size and for the join.
    """
    possible = lookup_join(bigrams.select(side, "token"), pairs, ["token"], "inner", [side], odd)
    known = bigrams.select(side, F.col("token").alias("candidate"), F.col("n").alias("c"))
    seen = (
        possible.join(known.hint("merge"), [side, "candidate"])
        .groupBy(side, "token")
        .agg(F.map_from_entries(F.collect_list(F.struct("candidate", "c"))).alias(out))
    )
    return materialize(seen, f"seen-{out}")


def correct_in_context_wide(df: DataFrame, corrected: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Apply the output of :func:`correct_in_context` to an annotation array."""
    return map_tokens(df, corrected.select("doc_id", "i", F.col("corrected").alias("value")), tokens)
