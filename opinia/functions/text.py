"""Column expressions for one text or one token list. All of them are built-in Spark
expressions, so they run in the JVM next to the scan and never add a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns. WORDS is the complement of the `\W` gap pattern, TOKENS the
# complement of `[^a-zA-Z0-9_']`.
WORDS = r"\w+"
TOKENS = r"[a-zA-Z0-9_']+"
TOKENS_HYPHEN = r"[a-zA-Z0-9_'\-]+"
TOKENS_UNICODE = r"[\p{L}\p{N}_']+"
# A word with inner apostrophes or hyphens, or a run of other marks.
# The possessive loop keeps the regex engine from recursing once per part.
RULE_TOKENS = r"[\p{L}\p{N}_]+(?:['\-][\p{L}\p{N}_]+)*+|[^\s\p{L}\p{N}_]+"
# White space that follows an end mark, written so that the regex engine looks back only
# from white space.
SENTENCE_GAP = r"\s(?<=[.!?]\s)\s*"

# What the regex engine takes for white space, as a set to trim: trimming by a pattern is
# quadratic in a run of blanks.
BLANKS = " \t\n\x0b\f\r"

WILD = "\u0001"
# Pairs of up to this length meet by patterns of the whole token, longer ones by those of its blocks.
LONG_TOKEN = 48
# At two edits, pairs of up to this length meet by deletions, longer ones by segments.
SHORT_TOKEN = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda can be inlined by the optimizer and then be evaluated
    once per array element; a lambda variable cannot.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ws_words(text: Column, drop_empty: bool = False) -> Column:
    """Lower-cased split on single white space. As in the Spark ML tokenizer, inner and
    leading empty tokens stay and trailing ones go; ``drop_empty`` removes all of them."""
    lowered = F.lower(text)
    trimmed = F.rtrim(lowered, F.lit(BLANKS))
    blank = (trimmed == "") & (lowered != "")
    words = F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s", -1))
    return F.array_remove(words, "") if drop_empty else words


def words(text: Column, pattern: str = WORDS, gaps: bool = False, min_length: int = 1) -> Column:
    """Lower-cased regex tokens. ``pattern`` describes tokens, or separators with ``gaps``.

    Matching tokens directly is several times faster than splitting and dropping empties.
    """
    lowered = F.lower(text)
    if gaps:
        found = F.split(lowered, pattern, -1)
    else:
        found = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))
    if min_length > 1:
        return F.filter(found, lambda w: F.length(w) >= min_length)
    return F.array_remove(found, "") if gaps and min_length == 1 else found


def sentences(text: Column) -> Column:
    """The sentences of a text: split at white space after an end mark."""
    return F.array_remove(F.split(text, SENTENCE_GAP, -1), "")


def extract(text: Column, pattern: str, lowercase: bool) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, F.lower) if lowercase else found


def token_starts(text: Column, token_class: str) -> Column:
    """Character offsets at which tokens begin, in one linear pass over the text.

    Everything outside the class is blanked, then a token starts at each non-blank
    character whose left neighbour is blank.
    """
    mask = F.split(F.regexp_replace(text, negated(token_class), " "), "")

    def starts(chars: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(chars) - 1),
            lambda i: (F.get(chars, i) != " ") & ((i == 0) | (F.get(chars, i - 1) == " ")),
        )

    return let(mask, starts)


def negated(token_class: str) -> str:
    """``[abc]+`` -> ``[^abc]``."""
    if not (token_class.startswith("[") and token_class.endswith("]+")):
        raise ValueError("offsets need a token pattern of the form [..]+")
    return "[^" + token_class[1:-1]


def annotated_tokens(
    text: Column, pattern: str = TOKENS, lowercase: bool = True, offsets: bool = False
) -> Column:
    """``array<struct<result, sent, pos[, begin, end]>>``: the tokens of each sentence.

    ``pos`` counts inside the sentence. End marks and white space are never token
    characters, so the tokens of all sentences in order are the tokens of the text, and
    the k-th of them begins at the k-th token start of the text.
    """

    def of_sentence(sentence: Column, sent: Column) -> Column:
        return F.transform(
            extract(sentence, pattern, lowercase),
            lambda token, pos: F.struct(
                token.alias("result"), sent.cast("int").alias("sent"), pos.cast("int").alias("pos")
            ),
        )

    tokens = F.flatten(F.transform(sentences(text), of_sentence))
    if not offsets:
        return tokens

    def with_offsets(starts: Column) -> Column:
        def place(token: Column, k: Column) -> Column:
            begin = F.get(starts, k).cast("int")
            return F.struct(
                token["result"].alias("result"),
                token["sent"].alias("sent"),
                token["pos"].alias("pos"),
                begin.alias("begin"),
                (begin + F.length(token["result"]) - 1).alias("end"),
            )

        return F.transform(tokens, place)

    return let(token_starts(text, pattern), with_offsets)


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Space-joined runs of ``n`` tokens; none when there are fewer than ``n``."""

    def grams(ws: Column) -> Column:
        return F.when(
            F.size(ws) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(ws) - (n - 1)),
                lambda i: F.array_join(F.slice(ws, i, n), " "),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return let(tokens, grams)


def drop_words(tokens: Column, stop: Iterable[str], case_sensitive: bool = False) -> Column:
    """Tokens outside the stop list. The list is a literal set, looked up by hash."""
    stop = list(stop)
    if case_sensitive:
        return F.filter(tokens, lambda t: ~t.isin(stop))
    lowered = sorted({w.lower() for w in stop})
    return F.filter(tokens, lambda t: ~F.lower(t).isin(lowered))


def token_counts(tokens: Column) -> Column:
    """``array<struct<token, tf>>``: the distinct tokens of one row and their counts.

    The tokens are sorted inside the row and the run starts are kept, so counting terms per
    document needs no shuffle.
    """

    def runs(ordered: Column) -> Column:
        firsts = F.filter(
            F.transform(
                ordered,
                lambda t, i: F.when(
                    (i == 0) | (t != F.get(ordered, i - 1)), F.struct(t.alias("t"), i.alias("i"))
                ),
            ),
            lambda run: run.isNotNull(),
        )
        return let(
            firsts,
            lambda starts: F.transform(
                starts,
                lambda run, k: F.struct(
                    run["t"].alias("token"),
                    (F.coalesce(F.get(starts, k + 1)["i"], F.size(ordered)) - run["i"]).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(tokens), runs)


def apply_edits(tokens: Column, edits: Column) -> Column:
    """Replace tokens at the positions named in ``edits`` (``array<struct<i, value>>`` sorted
    by ``i``), by cutting the list between the edits: linear in the document."""

    def cut(ts: Column) -> Column:
        def pieces(es: Column) -> Column:
            def piece(k: Column) -> Column:
                start = F.when(k == 0, F.lit(0)).otherwise(F.get(es, k - 1)["i"] + 1)
                stop = F.when(k == F.size(es), F.size(ts)).otherwise(F.get(es, k)["i"])
                kept = F.slice(ts, start + 1, F.greatest(stop - start, F.lit(0)))
                edited = F.transform(
                    F.slice(es, k + 1, 1),
                    lambda e: F.get(ts, e["i"]).withField("result", e["value"]),
                )
                return F.concat(kept, edited)

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(es)), piece))

        return F.when(edits.isNull(), ts).otherwise(let(edits, pieces))

    return let(tokens, cut)


def _none() -> Column:
    return F.array().cast("array<string>")


def _variants(token: Column, replacement: str, kind: Column | str = "") -> Column:
    """``kind`` followed by the token with each character in turn replaced; none for an empty token."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.when(
        F.length(token) > 0,
        F.transform(
            F.sequence(F.lit(1), F.length(token)),
            lambda i: F.concat(kind, F.overlay(token, F.lit(replacement), i, F.lit(1))),
        ),
    ).otherwise(_none())


def _swaps(token: Column, kind: Column) -> Column:
    """``kind`` followed by the token with each two neighbours in turn exchanged."""
    pair = lambda i: F.concat(F.substring(token, i + 1, F.lit(1)), F.substring(token, i, F.lit(1)))
    return F.when(
        F.length(token) > 1,
        F.transform(
            F.sequence(F.lit(1), F.length(token) - 1),
            lambda i: F.concat(kind, F.overlay(token, pair(i), i, F.lit(2))),
        ),
    ).otherwise(_none())


# Kinds of keys: the suspect is longer (or has two neighbours exchanged), shorter, or as long.
TOO_LONG, TOO_SHORT, SUBSTITUTED = "+", "-", "*"


def _patterns(token: Column, is_suspect: bool, transpositions: bool, prefix: Column) -> Column:
    """The patterns that a token shares with those one edit away, but for what it shares as it is
    with longer ones."""
    kind = lambda k: F.concat(F.lit(k), prefix)
    same = _variants(token, WILD, kind(SUBSTITUTED))
    if not is_suspect:
        # Words are met as they are by suspects that are swapped.
        return F.concat(F.array(F.concat(kind(TOO_LONG), token)), _variants(token, "", kind(TOO_SHORT)), same)
    shorter = _variants(token, "", kind(TOO_LONG))
    return F.concat(shorter, _swaps(token, kind(TOO_LONG)), same) if transpositions else F.concat(shorter, same)


def edit_keys(token: Column, is_suspect: bool, transpositions: bool) -> Column:
    """Keys that a suspect and a dictionary word share exactly when one edit separates them.

    A suspect with one character too many equals a word once a character is deleted, one
    with a character too few equals a shortened word, and a substitution leaves the same
    pattern once that position is blanked. Each kind has its own key prefix, so unlike a
    plain delete neighbourhood no pair at a larger distance is produced, and each pair is
    produced once.

    All patterns of a token take the square of its length. Pairs whose longer token has more than
    ``LONG_TOKEN`` characters meet by blocks instead: the edit lies in one block of the longer
    token, and what is before and after the block is equal, so a key is these two, as digests,
    and a pattern of the block. However much tokens have in common, a key is shared only by those that
    one edit separates; a pair with several equal keys counts once (:func:`met_once`). Beyond the square
    of ``LONG_TOKEN`` the blocks grow with the token, so that it has no more of them, and a key
    is the digests alone: those who share it are equal but for one block, and are verified.
    """
    plain = _patterns(token, is_suspect, transpositions, F.lit(""))
    # The other token of the pair is the longer one here.
    as_is = TOO_SHORT if is_suspect else TOO_LONG
    below = F.when(F.length(token) < LONG_TOKEN, F.array(F.concat(F.lit(as_is), token))).otherwise(_none())
    whole = F.when(F.length(token) <= LONG_TOKEN, F.concat(plain, below) if is_suspect else plain).otherwise(_none())
    size = F.length(token)
    digests = lambda prefix: F.array(F.concat(F.lit("="), prefix))
    huge = lambda length: length > LONG_TOKEN * LONG_TOKEN
    own = _block_keys(
        token, size,
        lambda part, prefix: F.when(huge(size), digests(prefix)).otherwise(_patterns(part, is_suspect, transpositions, prefix)),
    )
    longer = _block_keys(
        token, size + 1,
        lambda part, prefix: F.when(huge(size + 1), digests(prefix)).otherwise(F.array(F.concat(F.lit(as_is), prefix, part))),
    )
    return F.array_distinct(F.concat(whole, own, longer))


def _block(longest: Column) -> Column:
    """Characters of a block of a token of this length."""
    return F.greatest(F.lit(LONG_TOKEN), F.ceil(longest / LONG_TOKEN)).cast("int")


def _block_keys(token: Column, longest: Column, keys: Callable[[Column, Column], Column]) -> Column:
    """Keys of the blocks, for pairs whose longer token has ``longest`` characters. Blocks run one
    character into the next, so that two neighbours are always in one."""

    def of_block(j: Column) -> Column:
        size = _block(longest)
        start = j * size
        after = F.greatest(longest - start - size - 1, F.lit(0))
        part = F.substring(token, start + 1, F.greatest(F.length(token) - start - after, F.lit(0)))
        before = F.substring(token, F.lit(1), start)
        rest = F.substring(token, F.length(token) - after + 1, after)
        prefix = F.concat_ws(
            ":", F.lit("#"), longest.cast("string"), j.cast("string"),
            F.md5(before.cast("binary")), F.md5(rest.cast("binary")), F.lit(""),
        )
        return let(part, lambda p: keys(p, prefix))

    blocks = F.sequence(F.lit(0), F.floor((longest - 1) / _block(longest)).cast("int"))
    return F.when(longest > LONG_TOKEN, F.flatten(F.transform(blocks, of_block))).otherwise(_none())


def met_by_block(key: Column) -> Column:
    return F.substring(key, F.lit(2), F.lit(1)) == "#"


def met_once(key: Column, a: Column, b: Column) -> Column:
    """Whether a pair that met by blocks did so in the one in which it first differs."""
    longest = F.greatest(F.length(a), F.length(b))
    block = F.split(key, ":")
    first = F.floor((first_difference(a, b) - 1) / _block(longest)).cast("string")
    return (F.get(block, F.lit(1)) == longest.cast("string")) & (F.get(block, F.lit(2)) == first)


def first_difference(a: Column, b: Column) -> Column:
    """The first place, from 1, at which two texts differ; that after the shorter if it is a prefix."""
    differs = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), F.lit(True))
    return F.when(differs > 0, differs).otherwise(F.least(F.length(a), F.length(b)) + 1).cast("int")


def one_edit(a: Column, b: Column, transpositions: bool) -> Column:
    """Whether one edit turns one into the other, in time linear in their length: what follows
    the first difference decides."""

    def from_first(at: Column) -> Column:
        rest = lambda word, k: F.substring(word, at + k, F.length(word))
        same = F.length(a) == F.length(b)
        found = (
            (same & (rest(a, 1) == rest(b, 1)))
            | ((F.length(a) == F.length(b) + 1) & (rest(a, 1) == rest(b, 0)))
            | ((F.length(b) == F.length(a) + 1) & (rest(a, 0) == rest(b, 1)))
        )
        if transpositions:
            one = lambda word, k: F.substring(word, at + k, F.lit(1))
            found |= same & (one(a, 0) == one(b, 1)) & (one(a, 1) == one(b, 0)) & (rest(a, 2) == rest(b, 2))
        return found

    return (a != b) & let(first_difference(a, b), from_first)


def delete_keys(token: Column, depth: int) -> Column:
    """The token and everything reached by up to ``depth`` deletions."""
    level = F.array(token)
    reached = level
    for _ in range(depth):
        level = F.array_distinct(F.flatten(F.transform(level, lambda t: _variants(t, ""))))
        reached = F.concat(reached, level)
    return F.array_distinct(reached)


def bigram_mask(token: Column) -> Column:
    """64 bits that the pairs of neighbouring characters of a token set. An edit replaces two of the
    pairs by two others at most, so it changes no more than four bits."""
    bit = lambda i: F.pmod(F.xxhash64(F.substring(token, i, F.lit(2))), F.lit(64)).cast("int")
    pairs = F.sequence(F.lit(1), F.greatest(F.length(token) - 1, F.lit(1)))
    one = F.lit(1).cast("long")
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda mask, i: mask.bitwiseOR(F.call_function("shiftleft", one, bit(i))))


def segment_keys(token: Column, is_suspect: bool, edits: int) -> Column:
    """Keys that a suspect and a word share if at most ``edits`` edits separate them, and the longer
    one has more than ``SHORT_TOKEN`` characters.

    A word is cut into one more segment than there are edits, so one of them is untouched. The edits
    before it move it by as many places at most, so a suspect looks for each segment of a word
    of each possible length at these places only. Pairs that meet have to be verified.
    """
    parts = edits + 1

    def bounds(length: Column, i: int) -> tuple[Column, Column]:
        """Start from 0 and size; all segments but the last have a ``parts``-th."""
        step = F.floor(length / parts).cast("int")
        return step * i, (length - step * i if i == parts - 1 else step)

    def key(length: Column, i: int, part: Column) -> Column:
        return F.concat_ws(":", length.cast("string"), F.lit(str(i)), part)

    size = F.length(token)
    if not is_suspect:
        own = []
        for i in range(parts):
            start, length = bounds(size, i)
            own.append(key(size, i, F.substring(token, start + 1, length)))
        return F.when(size > SHORT_TOKEN - edits, F.array(*own)).otherwise(_none())

    def of_length(other: Column) -> Column:
        found = []
        for i in range(parts):
            start, length = bounds(other, i)
            for shift in range(-edits, edits + 1):
                at = start + shift
                inside = (at >= 0) & (at + length <= size)
                found.append(F.when(inside, key(other, i, F.substring(token, at + 1, length))))
        return F.when(F.greatest(size, other) > SHORT_TOKEN, F.array_compact(F.array(*found))).otherwise(_none())

    lengths = F.filter(F.sequence(size - edits, size + edits), lambda n: n >= parts)
    return F.when(
        size > SHORT_TOKEN - edits, F.array_distinct(F.flatten(F.transform(lengths, of_length)))
    ).otherwise(_none())
