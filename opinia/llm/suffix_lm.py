"""Language-model scores by a probabilistic suffix tree over the bytes of a token sequence.

A text's tokens (lower-cased words and an end) are written as bytes: words, one blank between
them, a line feed at the end. Neither occurs in words, so the bytes and the tokens determine each
other, and the tree's probability of the bytes is one of the tokens, unseen words included.

All strings of ``DEPTH`` bytes and the byte after them are counted over the whole training part.
A context of up to ``DEPTH`` bytes is a candidate if it was seen ``least`` times, whatever the
size of the corpus, and all its transitions are listed. A candidate is retained if its next-byte
distribution diverges enough from that of its suffix one byte shorter (the gain in
log-likelihood has to pay a price for each transition), or if it has a retained child.
Distributions are interpolated with the suffix's, with as much weight as the context has
transitions. A byte is scored in the state of the longest retained suffix of what precedes it.

Counts, tests and retained states are tables. The tasks hold the states of the most frequent
contexts, at most ``room`` transitions, and know of each whether it has a retained child that
is not among them. Bytes after such a child are looked up by a join, all others in the task, so
``room`` does not change a score.

The base score needs the count of each token. Words that make up at least ``frequent`` of the
training tokens (at most 1 / frequent of them) are looked up in the task; all others are joined.

Defined results: a null or empty text is the end token alone; without training documents the
tree is uniform, N and V are 0 and the base score counts only the pseudo-count; repeated rows are each
counted and scored; a null id hashes as ''; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, bucket, parts_by_bytes, release, split_words, utf8

DEPTH = 5
WINDOW_BITS = 8 * (DEPTH + 1)
BEFORE = b"\0" * (DEPTH - 1) + b"\n"
#: Bytes whose windows are sorted at once.
STEP = 1 << 20
#: Distinct windows and words that a task gathers before it passes them on.
GATHER = 1 << 20
#: Counts that a task passes on, and texts and bytes that it scores, at once.
PASS_ROWS, SCORE_ROWS, SCORE_BYTES = 1 << 16, 512, 4 * STEP
WORD, WINDOW = 0, 1
#: What a retained transition has to gain, in logs of the number of training bytes.
PRICE = 0.1
#: Transitions that the tasks hold; the states of other contexts are joined.
ROOM = 1 << 21


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def segments(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A stream in parts of at most ``STEP`` bytes, each with the ``DEPTH`` bytes before it."""
    before = BEFORE
    for k in range(0, len(text), STEP):
        yield before, text[k : k + STEP]
        before = (before + text[k : k + STEP])[-DEPTH:]


def windows(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The window that ends at each byte, as a number (the byte itself is the lowest), and the
    first window of each part."""
    data = np.frombuffer(b"".join(x for part in parts for x in part), np.uint8)
    n = len(data) - DEPTH
    code = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        code = (code << 8) | data[k : k + n]
    sizes = np.array([len(body) for _, body in parts])
    ends = np.cumsum(sizes + DEPTH) - DEPTH
    keep = np.ones(n, bool)
    for e in ends[:-1]:
        keep[e : e + DEPTH] = False
    return code[keep], np.concatenate(([0], np.cumsum(sizes)[:-1]))


def _groups(words_of: Iterator[list[bytes]]) -> Iterator[tuple[list[int], list[tuple[bytes, bytes]]]]:
    """Parts of streams in groups of at most two ``STEP`` bytes, with the numbers of their texts."""
    owners, group, size = [], [], 0
    for k, words in enumerate(words_of):
        for part in segments(stream(words)):
            owners.append(k)
            group.append(part)
            size += len(part[1])
            if size >= STEP:
                yield owners, group
                owners, group, size = [], [], 0
    if group:
        yield owners, group


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``(kind, key, n)`` of the training part's words and windows; ``docs``: ``_text`` bytes."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def rows(kind: int, keys: pa.Array, n) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(n), PASS_ROWS):
                some = pa.array(n[at : at + PASS_ROWS], pa.int64())
                kinds = pa.array(np.full(len(some), kind, np.int32))
                part = keys.slice(at, PASS_ROWS).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([kinds, part, some], names=["kind", "key", "n"])

        def pass_words() -> Iterator[pa.RecordBatch]:
            if words:
                yield from rows(WORD, pa.array(list(words), pa.binary()), list(words.values()))
                words.clear()

        def merge() -> None:
            code, n = (np.concatenate(x) for x in zip(*seen))
            seen.clear()
            order = np.argsort(code)
            code = code[order]
            n = n[order]
            del order
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            seen.append((code[first], np.add.reduceat(n, first)))

        def pass_windows() -> Iterator[pa.RecordBatch]:
            if seen:
                merge()
                code, n = seen.pop()
                big = code.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - DEPTH - 1 :]
                raw = pa.py_buffer(np.ascontiguousarray(big).data)
                del code, big
                yield from rows(WINDOW, pa.FixedSizeBinaryArray.from_buffers(pa.binary(DEPTH + 1), len(n), [None, raw]), n)

        def split(batches) -> Iterator[list[bytes]]:
            for b in batches:
                for text in b.column("_text"):
                    some = split_words(text.as_py().lower())
                    words.update(some)
                    yield some

        try:
            for _, group in _groups(split(found)):
                seen.append(np.unique(windows(group)[0], return_counts=True))
                held += len(seen[-1][0])
                if held > 4 * GATHER:
                    merge()
                    held = len(seen[0][0])
                    if held > 2 * GATHER:
                        yield from pass_windows()
                        held = 0
                if len(words) > GATHER // 2:
                    yield from pass_words()
            yield from pass_words()
            yield from pass_windows()
        finally:
            release()

    return docs.select("_text").mapInArrow(run, "kind int, key binary, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass
class Tree:
    """By length k of the context: the retained contexts and what of their mass goes to the
    shorter context; the listed transitions (context and byte in one number) and their probability.
    A context that is known not to be retained passes all its mass on. ``more`` marks those with
    a retained child that the tree does not hold."""

    root: np.ndarray
    contexts: list[np.ndarray]
    share: list[np.ndarray]
    moves: list[np.ndarray]
    chance: list[np.ndarray]
    more: list[np.ndarray] = field(default_factory=list)

    def probability(self, code: np.ndarray) -> np.ndarray:
        """Of the lowest byte of each window, after the bytes above it."""
        return self.look_up(code)[0]

    def look_up(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`probability`, and whether a state that the tree does not hold may change it."""
        p = self.root[code & 255]
        away = np.full(len(code), bool(len(self.more) and self.more[0][0]))
        for k in range(1, len(self.contexts)):
            if not len(self.contexts[k]):
                break
            context = (code >> 8) & ((1 << 8 * k) - 1)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            state = self.contexts[k][at] == context
            p = np.where(state, p * self.share[k][at], p)
            if self.more:
                away = np.where(state, self.more[k][at], away)
            if len(self.moves[k]):
                move = code & ((1 << 8 * (k + 1)) - 1)
                to = np.minimum(np.searchsorted(self.moves[k], move), len(self.moves[k]) - 1)
                p = np.where(state & (self.moves[k][to] == move), self.chance[k][to], p)
        return p, away

    def log10(self, parts: list[tuple[bytes, bytes]]) -> np.ndarray:
        """log10 probability of each part, given what precedes it."""
        code, starts = windows(parts)
        some, at = np.unique(code, return_inverse=True)
        return np.add.reduceat(np.log10(self.probability(some))[at], starts)

    def log10_held(
        self, owners: list[int], parts: list[tuple[bytes, bytes]]
    ) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`log10` of the bytes that the tree decides alone; and of the others the owner of the
        part, the window, how often it is there, and its log10 probability as far as the tree knows."""
        code, starts = windows(parts)
        some, at = np.unique(code, return_inverse=True)
        p, away = self.look_up(some)
        logs = np.log10(p)
        sums = np.add.reduceat(np.where(away, 0.0, logs)[at], starts)
        # A window has (DEPTH + 1) * 8 bits; the owner is a number within a batch.
        out = np.flatnonzero(away[at])
        owner = np.repeat(np.array(owners, np.int64), np.diff(np.append(starts, len(code))))[out]
        pairs, n = np.unique(owner << WINDOW_BITS | code[out], return_counts=True)
        window = pairs & ((1 << WINDOW_BITS) - 1)
        return sums, (pairs >> WINDOW_BITS, window, n, logs[np.searchsorted(some, window)])


def grow(
    moves: list[tuple[np.ndarray, np.ndarray]],
    contexts: list[tuple[np.ndarray, np.ndarray]],
    total: int,
    price: float = PRICE,
) -> Tree:
    """The tree from the transitions and contexts of each length 0 .. DEPTH, as sorted numbers with
    counts, in one process. :func:`train` makes the same tree of tables; tests hold it to this."""
    codes, n = moves[0]
    listed = np.zeros(256)
    listed[codes] = n
    root = (listed + (256 + total - listed.sum()) / 256) / (total + 256)
    empty = np.zeros(0, np.int64)
    tree = Tree(root, [empty], [np.zeros(0)], [empty], [np.zeros(0)])
    gains: list[np.ndarray] = [np.zeros(0)]
    for k in range(1, DEPTH + 1):
        context, size = contexts[k]
        move, n = moves[k]
        known = np.isin(move >> 8, context)
        move, n = move[known], n[known]
        at = np.searchsorted(context, move >> 8)
        sums = lambda x: np.bincount(at, x, minlength=len(context))  # noqa: B023, E731
        spread = np.bincount(at, minlength=len(context))
        # What is not listed keeps its mass, which goes to the bytes that are not listed.
        rest = size - sums(n)
        # The shorter context of a frequent one is frequent, so it is in the tree so far.
        shorter = tree.probability(move)
        others = np.maximum(1 - sums(shorter), 1e-9)
        tree.contexts.append(context)
        tree.share.append((spread + rest / others) / (size + spread))
        tree.moves.append(move)
        tree.chance.append((n + spread[at] * shorter) / (size + spread)[at])
        gains.append(sums(n * np.log(n / size[at] / shorter)) - price * np.log(max(total, 2)) * spread)
    needed = empty
    for k in range(DEPTH, 0, -1):
        context = tree.contexts[k]
        kept = (gains[k] > 0) | np.isin(context, needed)
        of_kept = kept[np.searchsorted(context, tree.moves[k] >> 8)] if len(context) else np.zeros(0, bool)
        needed = np.unique(context[kept] & ((1 << 8 * (k - 1)) - 1)) if k > 1 else empty
        tree.contexts[k], tree.share[k] = context[kept], tree.share[k][kept]
        tree.moves[k], tree.chance[k] = tree.moves[k][of_kept], tree.chance[k][of_kept]
    return tree


def _low(column: str, n_bytes: int) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << 8 * n_bytes) - 1).cast("long"))


def grow_table(counts: DataFrame, scratch: Scratch, least: int, price: float = PRICE) -> tuple[DataFrame, int, np.ndarray]:
    """The candidates' transitions ``(k, context, move, size, spread, chance, kept)``, of all
    lengths k from 1; the number of training bytes; and the counts of single bytes."""
    found = counts.where(F.col("kind") == WINDOW).select(F.conv(F.hex("key"), 16, 10).cast("long").alias("code"), "n")
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    every = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _low("code", k + 1).alias("move")) for k in range(DEPTH + 1)]))
    moves = scratch.store(
        found.select("n", every.alias("e")).groupBy("e.k", "e.move").agg(F.sum("n").alias("n")), "transitions"
    )
    singles = np.zeros(256)
    for r in moves.where("k = 0").collect():
        singles[r["move"]] = r["n"]
    cost = price * float(np.log(max(total, 2)))
    within = Window.partitionBy("context")
    before = moves.where("k = 0").select("move", ((F.col("n") + 1) / F.lit(float(total + 256))).alias("chance"))
    levels = []
    for k in range(1, DEPTH + 1):
        shorter = before.select(F.col("move").alias("_move"), F.col("chance").alias("_shorter"))
        # A context has at most 256 transitions, and a transition at most 256 one byte longer.
        level = (
            moves.where(F.col("k") == k)
            .withColumn("_move", _low("move", k))
            .join(shorter, "_move")
            .withColumn("context", F.shiftright("move", 8))
            .withColumn("size", F.sum("n").over(within))
            .withColumn("spread", F.count("*").over(within))
            .withColumn("_sum", F.sum(F.col("n") * F.log(F.col("n") / F.col("_shorter"))).over(within))
            .where(F.col("size") >= least)
            .withColumn("chance", (F.col("n") + F.col("spread") * F.col("_shorter")) / (F.col("size") + F.col("spread")))
            .withColumn("gains", F.col("_sum") - F.col("size") * F.log("size") - F.lit(cost) * F.col("spread") > 0)
            .select("k", "context", "move", "size", "spread", "chance", "gains")
        )
        before = scratch.store(level, f"level-{k}")
        levels.append(before)
    # Retained contexts are those that gain, and their suffixes.
    retained = None
    for k, level in enumerate(levels, 1):
        suffixes = F.array(*[F.struct(F.lit(j).alias("k"), _low("context", j).alias("context")) for j in range(1, k + 1)])
        some = level.where("gains").select("context").distinct().select(F.inline(suffixes))
        retained = some if retained is None else retained.unionByName(some)
    candidates = levels[0]
    for level in levels[1:]:
        candidates = candidates.unionByName(level)
    retained = retained.distinct().withColumn("_kept", F.lit(True))
    kept = candidates.join(retained, ["k", "context"], "left").withColumn("kept", F.coalesce("_kept", F.lit(False)))
    return scratch.store(kept.drop("_kept", "gains"), "states"), total, singles


def train(counts: DataFrame, scratch: Scratch, least: int, room: int = ROOM) -> tuple[Tree, DataFrame | None]:
    """The tree of the most frequent contexts, from :func:`corpus_counts`, and the other retained
    states, ``(k, context, share, chances)``, if there are any. The driver gets the former: at
    most ``room`` transitions and contexts without one."""
    states, total, singles = grow_table(counts, scratch, least)
    # By powers of two of the number of occurrences: what a tree with all from there on has.
    weight = F.when(F.col("kept"), F.lit(1.0)).otherwise(1 / F.col("spread"))
    sizes = states.groupBy(F.floor(F.log2("size") + F.lit(1e-9)).alias("power")).agg(F.sum(weight).alias("n")).collect()
    floor, held = 1 << 62, 0.0
    for r in sorted(sizes, key=lambda r: -r["power"]):
        held += r["n"]
        if held > room:
            break
        floor = 1 << r["power"]
    else:
        floor = least
    inside = states.where(F.col("size") >= floor)
    outside = states.where((F.col("size") < floor) & F.col("kept"))
    whole = floor <= least
    parents = outside.select((F.col("k") - 1).alias("k"), F.when(F.col("k") > 1, _shorter_context()).otherwise(0).alias("context"))
    parents = parents.distinct().withColumn("more", F.lit(True))
    contexts = inside.groupBy("k", "context").agg(
        F.max("kept").alias("kept"), F.max(F.col("spread") / (F.col("size") + F.col("spread"))).alias("share")
    )
    contexts = contexts.withColumn("more", F.lit(False)) if whole else contexts.join(parents, ["k", "context"], "left")
    contexts = contexts.select(
        "k", "context", F.when(F.col("kept"), F.col("share")).otherwise(1.0).alias("share"), F.coalesce("more", F.lit(False)).alias("more")
    )

    def by_length(df: DataFrame) -> list[list[np.ndarray]]:
        k, code, *values = (c.to_numpy() for c in df.toArrow().columns)
        order = np.lexsort((code, k))
        edges = np.searchsorted(k[order], np.arange(1, DEPTH + 2))
        parts = [order[a:b] for a, b in zip(edges, edges[1:])]
        return [[np.zeros(0, x.dtype), *(x[p] for p in parts)] for x in (code, *values)]

    codes, share, more = by_length(contexts)
    moves, chance = by_length(inside.where("kept").select("k", "move", "chance"))
    top = not whole and bool(parents.where("k = 0").head(1))
    more[0] = np.array([top])
    tree = Tree((singles + 1) / (total + 256), codes, share, moves, chance, more)
    if whole:
        return tree, None
    byte = F.col("move").bitwiseAND(F.lit(255).cast("long"))
    return tree, outside.groupBy("k", "context").agg(
        F.max(F.col("spread") / (F.col("size") + F.col("spread"))).alias("share"),
        F.map_from_entries(F.collect_list(F.struct(byte, F.col("chance")))).alias("chances"),
    )


def _shorter_context() -> Column:
    """The context of length k without its first byte."""
    found = F.lit(0).cast("long")
    for k in range(2, DEPTH + 1):
        found = F.when(F.col("k") == k, _low("context", k - 1)).otherwise(found)
    return found


def look_up_rest(windows_: DataFrame, rest: DataFrame) -> DataFrame:
    """``(code, factor, alone)`` of the distinct windows for which ``rest`` has a state: what the
    probability by the tree is to be multiplied with, or, where ``alone``, the probability."""
    contexts = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.shiftright(_low("code", k + 1), 8).alias("context"))
            for k in range(1, DEPTH + 1)
        ]
    )
    exploded = windows_.select("code").distinct().select("code", F.inline(contexts))
    byte = F.col("code").bitwiseAND(F.lit(255).cast("long"))
    found = exploded.join(rest.hint("merge"), ["k", "context"]).withColumn("chance", F.try_element_at("chances", byte))
    start = F.struct(F.lit(1.0).alias("factor"), F.lit(False).alias("alone"))
    step = lambda a, x: F.struct(
        F.coalesce(x["chance"], a["factor"] * x["share"]).alias("factor"),
        (a["alone"] | x["chance"].isNotNull()).alias("alone"),
    )
    # From the shortest context to the longest.
    by_window = found.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("k", "share", "chance"))).alias("_states"))
    return by_window.select("code", F.aggregate("_states", start, step).alias("_f")).select("code", "_f.*")


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out: int = 10,
    least: int = 2,
    frequent: float = 4e-6,
    pseudo: float = 0.1,
    room: int = ROOM,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per document.

    Documents whose crc32(id) modulo ``held_out`` is 0 are scored, but not learnt from.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-tree")
    named = docs.select(
        F.col(id_col).alias("doc_id"), (bucket(id_col, held_out) == 0).alias("held_out"), utf8(text_col).alias("_text")
    )
    learnt = named.where(~F.col("held_out"))
    counts = scratch.store(corpus_counts(learnt), "counts")
    tree, rest = train(counts, scratch, least, room)
    words = counts.where(F.col("kind") == WORD).select(F.col("key").alias("word"), F.col("n").alias("c"))
    sizes = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = learnt.count()
    n, v = (sizes["n"] or 0) + ends, sizes["v"] + (1 if ends else 0)
    norm = n + pseudo * (v + 1)
    top = words.where(F.col("c") >= max(2.0, frequent * n)).toArrow()
    known = dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))
    shared = spark.sparkContext.broadcast((tree, known))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tree, known = shared.value
        logs = dict(zip(known, np.log10((np.array(list(known.values()), float) + pseudo) / norm).tolist()))
        end = float(np.log10((ends + pseudo) / norm))
        row = TaskContext.get().partitionId() << 33
        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        away_type = pa.struct([("code", pa.int64()), ("n", pa.int64()), ("base", pa.float64())])
        try:
            for whole in found:
                sizes = pc.binary_length(whole.column("_text")).to_pylist()
                for b in parts_by_bytes(whole, sizes, SCORE_ROWS, SCORE_BYTES):
                    split = [split_words(t.lower()) for t in b.column("_text").to_pylist()]
                    rare, sums, seen = [], [], []
                    for some in split:
                        hits = [logs[w] for w in some if w in logs]
                        rest = Counter([w for w in some if w not in logs])
                        rare.append([{"word": w, "n": k} for w, k in rest.items()])
                        sums.append(sum(hits) + end)
                        seen.append(len(hits) + (1 if ends else 0))
                    scores = np.zeros(len(split))
                    away = []
                    for owners, group in _groups(iter(split)):
                        sums_of, more = tree.log10_held(owners, group)
                        np.add.at(scores, owners, sums_of)
                        away.append(more)
                    owner, *values = (np.concatenate(x) for x in zip(*away))
                    order = np.argsort(owner, kind="stable")
                    edges = np.searchsorted(owner[order], np.arange(len(split) + 1))
                    entries = pa.StructArray.from_arrays([pa.array(x[order]) for x in values], fields=list(away_type))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.arange(row, row + b.num_rows)),
                            b.column("doc_id"),
                            b.column("held_out"),
                            pa.array([len(x) + 1 for x in split], pa.int64()),
                            pa.array(seen, pa.int64()),
                            pa.array(sums, pa.float64()),
                            pa.array(scores),
                            pa.array(rare, rare_type),
                            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), entries),
                        ],
                        names=["_row", "doc_id", "held_out", "n_tokens", "_known", "_base", "score", "_rare", "_away"],
                    )
                    row += b.num_rows
        finally:
            release()

    kind = named.schema["doc_id"].dataType.simpleString()
    scored = scratch.store(
        named.mapInArrow(
            run,
            f"_row long, doc_id {kind}, held_out boolean, n_tokens long, _known long, _base double, score double, "
            "_rare array<struct<word: binary, n: bigint>>, _away array<struct<code: bigint, n: bigint, base: double>>",
        ),
        "scored",
    )
    rare = scored.select("_row", F.inline("_rare"))
    c = F.coalesce("c", F.lit(0))
    part = (
        rare.join(words.hint("merge"), "word", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("n") * F.log10((c + F.lit(pseudo)) / F.lit(norm))).alias("_more"),
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_found"),
        )
    )
    if rest is None:
        deeper = scored.select("_row", F.lit(0.0).alias("_deeper")).limit(0)
    else:
        away = scored.select("_row", F.inline("_away"))
        states = look_up_rest(away, scratch.store(rest, "rest"))
        log = F.log10("factor")
        term = F.when(F.col("alone"), log).otherwise(F.col("base") + F.coalesce(log, F.lit(0.0)))
        deeper = (
            away.join(states.hint("merge"), "code", "left")
            .groupBy("_row")
            .agg(F.sum(F.col("n") * term).alias("_deeper"))
        )
    return scored.drop("_rare", "_away").join(part, "_row", "left").join(deeper, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("_known") + F.coalesce("_found", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_deeper", F.lit(0.0))).alias("score"),
    )
