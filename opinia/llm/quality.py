"""Quality by weak supervision: rules vote or abstain, and a label model weighs them.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation estimates, without labels, the share of good documents and, for each
rule, how often its votes are right on good and on bad documents. A document is kept if its
posterior probability of being good is at least ``threshold``, however single rules voted.

The votes of a document are one of at most 3 ** rules patterns, so the model is fitted on the
counts of the patterns of all documents, which is a small table at any size of the corpus.

Defined results: a null or empty text has no words: all counts 0 and ``base_failed``; repeated
rows each get their row; a null id keeps its row; an empty table gives no rows; columns other
than the id and the text are only carried where a caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.llm.common import BLANKS, ROW, Scratch, release, split_words, texts_of, utf8, whole_row

#: Characters that prose has few of.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capital_words", "n_exclaimed", "n_sentence_ends", "top_word", "n_plain_words",
)
#: More distinct words than this could overflow a window's number.
MOST_DIRECT = 5000
#: Accuracy of votes on good and on bad documents that the estimates start from.
START = (0.95, 0.4)
#: By how much a bad vote is likelier on bad documents than on good ones, at least.
MARGIN = 0.02


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    code = ids[: n - window + 1].copy()
    for k in range(1, window):
        base = len(known)
        if base > MOST_DIRECT:  # number the pairs found so far anew, which keeps the product small
            code = np.unique(code, return_inverse=True)[1]
        code = code * base + ids[k : n - window + 1 + k]
    _, at, count = np.unique(code, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[at] > 1)
    if not again.size:
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The numbers of :data:`COUNTS`."""
    words = split_words(text)
    if not words:
        return (0,) * len(COUNTS)
    blanks = sum(text.count(c.encode()) for c in BLANKS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    capital = plain = ends = shouts = 0
    for w, n in seen.items():
        last = w[-1]
        if last == 33:
            shouts += n
        if last in b".!?":
            ends += n
        core = w.strip(b".,;:!?\"'()-")
        if core and not any(c in SYMBOLS for c in core):
            plain += n
        if len(core) > 1 and core.isupper():
            capital += n
    return (
        len(words),
        len(text.decode("utf-8", "replace")) - blanks,
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        capital,
        shouts,
        ends,
        max(seen.values()),
        plain,
    )


def text_counts(docs: DataFrame, text_col: str = "text", carry: tuple = ()) -> DataFrame:
    """``carry`` columns (or the whole row) and the numbers of :data:`COUNTS`, as longs."""
    carried = docs.select(*carry)
    names = carried.columns
    inside = text_col if names == [ROW] else None
    kept = carried if inside else docs.select(*carry, utf8(text_col).alias("_text"))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema] + [f"{c} long" for c in COUNTS]
    )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in found:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                rows = [counts(t) for t in texts_of(b, inside)]
                numbers = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(n) for n in names), *(pa.array(x) for x in numbers)], names=[*names, *COUNTS]
                )
        release()

    return kept.mapInArrow(run, schema)



def default_rules() -> dict[str, Column]:
    """Rules by name, as expressions on :data:`COUNTS` that are 1, -1 or 0."""
    c = F.col
    words = F.greatest(c("n_words"), F.lit(1))
    share = lambda name: c(name) / words
    length = c("word_chars") / words

    def rule(value: Column, good_below: float, bad_above: float, least: int = 10) -> Column:
        return F.when((c("n_words") >= least) & (value > bad_above), -1).when(
            (c("n_words") >= least) & (value < good_below), 1
        ).otherwise(0)

    return {
        "few_symbols": rule(share("n_symbols"), 0.02, 0.15),
        "few_capitals": rule(share("n_capital_words"), 0.1, 0.5),
        "few_shouts": rule(share("n_exclaimed"), 0.05, 0.3),
        "few_repeats": rule(share("n_repeat_words"), 0.02, 0.1),
        "few_equal_lines": rule(c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)), 0.05, 0.3),
        "mostly_words": rule(1 - share("n_plain_words"), 0.1, 0.3),
        "varied": rule(share("top_word"), 0.12, 0.25, 40),
        "has_sentences": rule(c("n_words") / F.greatest(c("n_sentence_ends"), F.lit(1)), 40.0, 80.0, 20),
        "word_length": F.when((c("n_words") >= 10) & ((length < 2) | (length > 14)), -1)
        .when((c("n_words") >= 10) & (length > 3) & (length < 10), 1)
        .otherwise(0),
        "long_enough": F.when(c("n_words") < 5, -1).when(c("n_words") >= 20, 1).otherwise(0),
    }


@dataclass(frozen=True)
class LabelModel:
    """``good``: share of good documents; ``right``: by rule, how often its votes are right
    on good and on bad documents."""

    names: tuple[str, ...]
    good: float
    right: np.ndarray

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds ahead of any vote, and what a good and a bad vote of each rule adds."""
        on_good, on_bad = self.right.T
        return (
            float(np.log(self.good / (1 - self.good))),
            np.log(on_good / (1 - on_bad)),
            np.log((1 - on_good) / on_bad),
        )

    def posterior(self) -> Column:
        """Probability that the document with these votes (columns ``vote_<name>``) is good."""
        start, up, down = self.weights()
        odds = F.lit(start)
        for name, a, b in zip(self.names, up, down):
            vote = F.col(f"vote_{name}")
            odds = odds + F.when(vote == 1, F.lit(float(a))).when(vote == -1, F.lit(float(b))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: list[tuple], names: tuple[str, ...], rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over (vote, ..., count) rows.

    Rules are taken to be independent given the class. A rule may overlook most bad documents,
    as each kind of junk shows in few of them, but a bad vote must be likelier on bad ones
    by ``MARGIN``; this also fixes which class is the good one. One pseudo-count
    keeps rules that never voted where they start.
    """
    votes = np.array([p[:-1] for p in patterns], float).reshape(len(patterns), len(names))
    n = np.array([p[-1] for p in patterns], float)
    good, right = 0.8, np.tile(START, (len(names), 1))
    if not len(n):
        return LabelModel(names, good, right)
    before = -np.inf
    for _ in range(rounds):
        a, b = right.T
        yes = (votes == 1) @ np.log(a) + (votes == -1) @ np.log(1 - a) + np.log(good)
        no = (votes == 1) @ np.log(1 - b) + (votes == -1) @ np.log(b) + np.log(1 - good)
        total = np.logaddexp(yes, no)
        p = np.exp(yes - total)
        likelihood = float(n @ total) / n.sum()
        if likelihood - before < tolerance:
            break
        before = likelihood
        g, h = n * p, n * (1 - p)
        voted = votes != 0
        a = np.clip((g @ (votes == 1) + START[0]) / (g @ voted + 1), 0.5, 0.9999)
        b = (h @ (votes == -1) + START[1]) / (h @ voted + 1)
        right = np.stack((a, np.clip(b, 1 - a + MARGIN, 0.9999)), 1)
        good = float(np.clip(g.sum() / n.sum(), 0.01, 0.99))
    return LabelModel(names, good, right)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    carry: tuple = ("doc_id",),
    rules: dict[str, Column] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``carry`` columns, :data:`COUNTS`, ``vote_<rule>``, ``posterior``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than 10 words, or over a fifth of them in repeated windows.
    """
    rules = default_rules() if rules is None else rules
    scratch = Scratch(docs.sparkSession, "quality")
    voted = scratch.store(
        text_counts(docs, text_col, carry).withColumns({f"vote_{k}": v for k, v in rules.items()}), "votes"
    )
    columns = [f"vote_{k}" for k in rules]
    patterns = [tuple(r) for r in voted.groupBy(*columns).count().collect()]
    model = fit(sorted(patterns), tuple(rules))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        voted.withColumn("posterior", model.posterior())
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= threshold))
    )


def keep_good(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`judge` keeps."""
    return judge(docs, text_col, (whole_row(docs),), **settings).where("kept").select(f"{ROW}.*")
