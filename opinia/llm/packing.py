"""Best-fit packing of token sequences by large-item matching.

Documents become pieces of at most ``capacity`` tokens. Pieces above a third of the capacity
go at most two to a sequence: the longest left is matched with the longest other one that
still fits. The smaller ones then go, longest first, where they leave the least room; only
what fits nowhere opens a new sequence.

Pieces of equal length are interchangeable, so all of this is decided on the histogram of
lengths, which has at most ``capacity`` rows however large the corpus is. The decisions are
runs: pieces ``first .. first + n`` of one length, in consecutive sequences at one offset. Each
run uses up a length or a group of equal sequences, or cuts one of these, so there are a few
thousand at most. Pieces are ranked within their length (in slices, where a length is frequent)
and look up their run; nothing but the histogram reaches the driver.

Token ids stay out of the ranking: places are decided for row numbers, and joined to the stored
pieces in the end.

Defined results: a null or empty text is the single end token; a text of any length is encoded whole (one
that is too much for the faster tokenizer, such as a million blanks, by the library that defines the
vocabulary, with the same ids); repeated rows are packed as often as they come; a null id keeps its rows;
an empty table gives no rows; of documents, columns other than the id and the text are not read; of
pieces, all are carried, whatever their names, but ``sequence_id`` and ``offset``, which are replaced.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, parts_by_bytes, release, unused, utf8

#: Rows of one length that are ranked by one task.
SLICE = 100_000
#: Documents and bytes of text that a task encodes at once.
DOCUMENTS, BYTES = 512, 4 << 20

_encodings: dict[tuple[str, str], object] = {}


def encoding(ranks_path: str, pattern: str, special: dict[str, int]):
    """A byte-level tokenizer from a rank file; one for each worker."""
    key = (ranks_path, pattern)
    if key not in _encodings:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[key] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _encodings[key]


def defining_ids(vocabulary_path: str, text: str) -> list[int]:
    """The ids of a text by the vocabulary's own library, which is slower and has no limits."""
    if vocabulary_path not in _encodings:
        from tokenizers import Tokenizer

        _encodings[vocabulary_path] = Tokenizer.from_file(vocabulary_path)
    return _encodings[vocabulary_path].encode(text, add_special_tokens=False).ids


def token_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    special: dict[str, int],
    vocabulary_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: each document's tokens and the end token, in
    pieces of at most ``capacity``. All pieces of a longer document are full but the first.
    ``ids`` are little-endian unsigned 32-bit numbers. ``special`` tokens' strings in a text become
    these tokens; leave it empty to make them ordinary text. ``vocabulary_path`` is the same
    vocabulary for the library that defines it.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, allowed = encoding(ranks_path, pattern, special), set(special)
        for whole in found:
            sizes = pc.binary_length(whole.column("_text")).to_pylist()
            for b in parts_by_bytes(whole, sizes, DOCUMENTS, BYTES):
                rows, piece, start, length, ids = [], [], [], [], []
                for k, text in enumerate(b.column("_text").to_pylist()):
                    text = text.decode("utf-8", "replace")
                    try:
                        tokens = tokenizer.encode(text, allowed_special=allowed, disallowed_special=())
                    except ValueError:  # the pattern needs more stack than there is
                        tokens = defining_ids(vocabulary_path, text)
                    tokens = np.array(tokens, "<u4")
                    tokens = tokens.tobytes() + end
                    n = len(tokens) // 4
                    cut = 0
                    for p in range(-(-n // capacity)):
                        stop = (n - 1) % capacity + 1 if p == 0 else cut + capacity
                        rows.append(k)
                        piece.append(p)
                        start.append(cut)
                        length.append(stop - cut)
                        ids.append(tokens[4 * cut : 4 * stop])
                        cut = stop
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )
        release()

    kept = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("_text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


class _Bins:
    """Groups of equal sequences by the room they have left."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, count)
        self.opened = 0

    def add(self, first: int, count: int, room: int) -> None:
        if count and room:
            if room not in self.groups:
                insort(self.rooms, room)
                self.groups[room] = []
            self.groups[room].append((first, count))

    def best(self, length: int) -> tuple[int, int, int] | None:
        """(first, count, room) of a group that a piece of this length leaves least room in."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room]
            del self.rooms[at]
        return first, count, room

    def open(self, count: int) -> int:
        self.opened += count
        return self.opened - count


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, sequences, copies in each, first sequence, offset)."""
    bins, runs = _Bins(capacity), []
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)

    def place(length: int, count: int, copies: int, first: int, room: int) -> None:
        runs.append((length, used[length], count, copies, first, capacity - room))
        used[length] += count * copies
        left[length] -= count * copies

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        count = left[length]
        # The longest partner that fits; of the same length, two at a time.
        at = bisect_left(large, capacity - length + 1) - 1
        if at < 0:
            first = bins.open(count)
            place(length, count, 1, first, capacity)
            bins.add(first, count, capacity - length)
        elif large[at] == length:
            pairs, single = divmod(count, 2)
            first = bins.open(pairs + single)
            if pairs:
                place(length, pairs, 2, first, capacity)
                bins.add(first, pairs, capacity - 2 * length)
            if single:
                other = large[at - 1] if at else None
                place(length, 1, 1, first + pairs, capacity)
                if other is not None:
                    place(other, 1, 1, first + pairs, capacity - length)
                bins.add(first + pairs, 1, capacity - length - (other or 0))
        else:
            other = large[at]
            count = min(count, left[other])
            first = bins.open(count)
            place(length, count, 1, first, capacity)
            place(other, count, 1, first, capacity - length)
            bins.add(first, count, capacity - length - other)
        large = [n for n in large if left[n]]

    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            found = bins.best(length)
            if found is None:
                need = -(-left[length] // (capacity // length))
                found = (bins.open(need), need, capacity)
            first, count, room = found
            # The best place for the next copy is where the last one went, while it fits.
            copies = room // length
            full = min(count, left[length] // copies)
            if full:
                place(length, full, copies, first, room)
                bins.add(first, full, room - copies * length)
            rest, first = count - full, first + full
            some = min(copies, left[length])
            if rest and some:
                place(length, 1, some, first, room)
                bins.add(first, 1, room - some * length)
                rest, first = rest - 1, first + 1
            bins.add(first, rest, room)
    return runs


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``doc_id``, ``piece`` and ``length``.

    Further columns of ``pieces`` (ids, digests) come along. Pieces are written once, as they
    are counted first and placed then.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = pieces.drop("sequence_id", "offset")
    row, placed_row = unused(pieces, "_row", "_placed_row")
    stored = scratch.store(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    # Pieces that are equal in these are interchangeable.
    order = ["doc_id", "piece", *[c for c in ("start", "ids_crc32") if c in pieces.columns]]
    slim = stored.select(F.col(row).alias(placed_row), F.col("length").cast("long").alias("length"), F.struct(*order).alias("_order"))
    counts = {r["length"]: r["n"] for r in slim.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # A row for each length that occurs, at most `capacity`, with its runs in order.
    runs = spark.createDataFrame(
        plan(counts, capacity), "length long, first long, bins long, copies long, sequence long, at long"
    )
    by_length = runs.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first", "copies", "sequence", "at"))).alias("_runs")
    )

    # Lengths that more than one task should rank, and into how many slices; at most `capacity`.
    wide = {n: -(-c // SLICE) for n, c in sorted(counts.items()) if c > SLICE}
    slices = F.create_map(*[F.lit(x) for pair in wide.items() for x in pair])[F.col("length")] if wide else F.lit(None)
    sliced = slim.withColumn("_slice", F.pmod(F.xxhash64(placed_row), F.coalesce(slices.cast("long"), F.lit(1))))
    own = Window.partitionBy("length", "_slice").orderBy("_order", placed_row)
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("length", "_slice")
        .agg(F.count("*").alias("n"))
        .select("length", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )
    ranked = sliced.withColumn("_own", F.row_number().over(own) - 1).join(starts, ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_own"))
    # The last run that begins at or before the piece's rank.
    run = F.element_at(F.filter("_runs", lambda r: r["first"] <= F.col("_rank")), -1)
    found = ranked.join(F.broadcast(by_length), "length").withColumn("_run", run)
    along = F.col("_rank") - F.col("_run.first")
    places = scratch.store(
        found.select(
            placed_row,
            (F.col("_run.sequence") + F.floor(along / F.col("_run.copies"))).cast("long").alias("sequence_id"),
            (F.col("_run.at") + along % F.col("_run.copies") * F.col("length")).cast("long").alias("offset"),
        ),
        "places",
    )
    # The narrow side is hashed, so that the ids are dealt but not sorted.
    return (
        stored.join(places.hint("shuffle_hash"), stored[row] == places[placed_row]).drop(row, placed_row)
    )
