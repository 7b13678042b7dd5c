"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources share the words of the corpus by weight, but none gets more than ``most`` times
what it has; the excess goes to the others by weight until no target is above. A source whose
target is m times its words owes each document m copies: the whole part is certain, and the
fraction left is the document's inclusion probability, or that times the document's relative
``weight`` where one is given. A document's rank is its random odds divided by its inclusion
odds, (u / (1 - u)) / (p / (1 - p)), with u from a hash of the id. In the order of the rank a
source takes documents until the words it still owes are reached.

The documents that are taken are a prefix of that order; the one that would cross the target
is passed over, and the order goes on with the documents that fit into what is left, until none
does, so that what is missing in the end is less than any document passed over. Each round takes at
least one document of each source that it goes on with.

Whole copies and the cut are found from running sums over ranges of (source, rank), so the
size of a source does not matter. Sources are a small table, but not assumed to be one: their
running sums are found the same way.

Defined results: a null text has size 0; documents of size 0 take nothing; a null source is a
source, the last; repeated rows are documents of their own; with an empty table, or with no
words at all, nothing is taken; columns other than id, text, source and weight are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, prefix_sums, unused, word_count

#: Range of the hash that gives random numbers.
STEPS = 1 << 48


def uniform(id_col: str, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed only."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")
    return (drawn.cast("double") + F.lit(0.5)) / F.lit(float(STEPS))


def source_targets(
    sources: DataFrame, scratch: Scratch, cycle: Sequence[int] = (1, 2, 3), most: int = 3
) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, weight, target)``.

    Weights repeat over the sources in code point order, null last. Capped sources are those
    with the least most * size / weight: in that order, source k is capped if its cap is below
    its share of what is left once all before it are capped.
    """
    named = sources.withColumn("_last", F.col("source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    placed = prefix_sums(named, ["_last", "source"], {"_one": "_place"}, scratch, "sources")
    weights = F.array(*[F.lit(w) for w in cycle])
    weighed = scratch.store(
        placed.select(
            "source",
            "source_size",
            F.element_at(weights, (F.col("_place") % len(cycle) + 1).cast("int")).cast("long").alias("weight"),
            "_last",
        )
        .withColumn("_ratio", F.lit(most) * F.col("source_size") / F.col("weight"))
        .withColumn("_cap", F.lit(most) * F.col("source_size")),
        "weights",
    )
    total = weighed.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    n, w = total["n"] or 0, total["w"] or 0
    left = prefix_sums(
        weighed, ["_ratio", "_last", "source"], {"_cap": "_taken", "weight": "_used"}, scratch, "ratios"
    ).withColumn("_capped", F.col("_cap") * (F.lit(w) - F.col("_used")) < F.col("weight") * (F.lit(n) - F.col("_taken")))
    rest = left.agg(
        F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).alias("c"),
        F.sum(F.when(F.col("_capped"), F.col("weight")).otherwise(0)).alias("w"),
    ).first()
    share = F.col("weight") * F.lit(float(n - (rest["c"] or 0))) / F.lit(float(max(1, w - (rest["w"] or 0))))
    return left.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share).alias("target"),
    )


def _take_prefix(open_: DataFrame, scratch: Scratch) -> DataFrame:
    """``open_`` with ``_fits``: whether the running sum of its source up to and with this
    document stays within ``_owed``."""
    summed = scratch.store(
        prefix_sums(open_, ["_last", "source", "_rank", "doc_id", "size"], {"size": "_sum"}, scratch), "sums"
    )
    begins = summed.groupBy("source").agg(F.min("_sum").alias("_begin")).withColumnRenamed("source", "_source")
    return (
        summed.join(begins, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_fits", F.col("_sum") - F.col("_begin") + F.col("size") <= F.col("_owed"))
        .drop("_sum", "_begin", "_source")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    cycle: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 7,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken, *extra)``, a row per document;
    ``taken`` is ``copies * size``.

    ``weight_col`` (positive, null as 1) makes inclusion unequal inside a source; the certain
    copies stay equal, and the fraction p becomes p * weight, at most ``1 - 1e-9``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    relative = F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col else F.lit(1.0)
    sized = scratch.store(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
            relative.alias("_relative"),
            *extra,
        ),
        "sizes",
    )
    more = sized.columns[4:]
    sources = scratch.store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = scratch.store(source_targets(sources, scratch, cycle, most), "targets").withColumnRenamed("source", "_source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    chance = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") - F.col("_whole")).otherwise(0.0)
    known = (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_last", F.col("source").isNull())
        .withColumn("_whole", whole)
        .withColumn("_p", F.least(chance * F.col("_relative"), F.lit(1 - 1e-9)))
        .withColumn("_owed", F.col("target") - F.col("_whole") * F.col("source_size"))
    )
    u = uniform("doc_id", seed)
    ranked = known.withColumn("_rank", (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p"))))
    # Without a fraction, or without words, there is nothing to draw.
    draws = (F.col("_p") > 0) & (F.col("size") > 0) & (F.col("size") <= F.col("_owed"))
    names = ["doc_id", "source", "size", "source_size", "target", *more]
    settled = [
        ranked.where(~draws).select(*names, F.col("_whole").alias("copies"))
    ]
    still = ranked.where(draws).select(*names, "_last", "_whole", "_owed", "_rank")
    while True:
        cut = scratch.store(_take_prefix(still, scratch), "cut")
        settled.append(cut.where("_fits").select(*names, (F.col("_whole") + 1).alias("copies")))
        used = cut.where("_fits").groupBy("source").agg(F.sum("size").alias("_used")).withColumnRenamed("source", "_source")
        again = (
            cut.where("NOT _fits")
            .join(used, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("_owed", F.col("_owed") - F.coalesce("_used", F.lit(0)))
        )
        fits = F.col("size") <= F.col("_owed")
        settled.append(again.where(~fits).select(*names, F.col("_whole").alias("copies")))
        still = again.where(fits).drop("_used", "_source", "_fits")
        if still.isEmpty():
            break
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, as often as :func:`mix` copies them.

    Decisions find their rows by a hash of all columns. Rows that are equal throughout share
    their copies, so each such group is joined once, with the sum.
    """
    own, other, whose, n, copy = unused(docs, "_own", "_mark", "_id", "_copies", "_copy")
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)])
    decided = mix(docs, id_col, extra=(mark.alias("_mark"),), **settings)
    copies = decided.groupBy(F.col("_mark").alias(other), F.col("doc_id").alias(whose)).agg(F.sum("copies").alias(n)).where(F.col(n) > 0)
    marked = docs.withColumn(own, mark)
    same = (marked[own] == copies[other]) & marked[id_col].eqNullSafe(copies[whose])
    found = marked.join(copies.hint("shuffle_merge"), same)
    once = found.dropDuplicates([own, id_col])
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))
    return once.withColumn(copy, again).select(*[F.col(f"`{c}`") for c in docs.columns])
