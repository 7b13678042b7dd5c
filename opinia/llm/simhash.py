"""Near-duplicate classes by SimHash fingerprints and multi-index hashing.

A fingerprint is the bitwise majority of the hashes of a text's word shingles. Two
fingerprints link at ``distance`` or fewer differing bits. The 64 bits are cut into
segments; by the pigeonhole principle a linked pair differs by at most
``distance // segments`` bits in one of them, so every value in the Hamming ball of that
radius around each segment is looked up in the table of that segment, and the whole distance
of each match is verified. With two segments of 32 bits and three bits, a ball holds 33
values, and a table of ten billion fingerprints has few rows a key.

Only distinct fingerprints are joined. A key of a table that more than ``hot`` of them share
does not go through the join, which would emit all its pairs: its fingerprints are cut
into blocks, and each pair of blocks is one group, in which a spanning forest of the verified
links is found. That keeps the components, which are the result, and emits fewer rows
than fingerprints; no candidate is left out.

Defined results: a null text counts as empty; a text without words has fingerprint zero and
links like any other; repeated rows each keep their row; a null id is never the
``component_id`` unless all ids of the component are null; an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.llm.common import Scratch, split_words, unused, utf8
from opinia.llm.components import components

#: Fingerprints of a table key beyond which its pairs are found in blocks instead of by the join.
HOT = 128
#: Fingerprints in a block.
BLOCK = 2048
#: Shingles whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the XXH64 hashes (seed 42) of the shingles, as unsigned."""
    words = split_words(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    first, last = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(first), STEP):
        hashes = np.array(
            [digest(joined[a:b], 42) for a, b in zip(first[k : k + STEP], last[k : k + STEP])], dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(ones * 2 > len(first), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, extra: tuple = ()
) -> DataFrame:
    """``(doc_id, fp long, *extra)``: the fingerprint's bits as a signed long. ``extra`` are
    further columns (expressions with a name) to carry."""
    kept = docs.select(F.col(id_col).alias("doc_id"), *extra)
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", fp bigint"

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            fps = np.array([fingerprint(t, shingle) for t in b.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(fps.view(np.int64))], names=[*names, "fp"]
            )

    return docs.select(F.col(id_col).alias("doc_id"), *extra, utf8(text_col).alias("_text")).mapInArrow(run, schema)


def spanning_links(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links within ``distance`` bits that join the same fingerprints into components as all
    such links inside the union of ``a`` and ``b`` do; fewer than there are fingerprints."""
    rest = np.unique(np.concatenate((a, b))).view(np.uint64)
    links: list[tuple[int, int]] = []
    queue: list[np.uint64] = []
    while rest.size:
        if not queue:
            queue.append(rest[0])
            rest = rest[1:]
        at = queue.pop()
        near = np.bitwise_count(rest ^ at) <= distance
        if near.any():
            own = int(at.view(np.int64))
            links += [(own, int(x)) for x in rest[near].view(np.int64)]
            queue += list(rest[near])
            rest = rest[~near]
    return links


def _segments(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    cuts = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _ball(segment: int, value: Column, width: int, radius: int) -> Column:
    """(seg, key) of the values within ``radius`` bits of a segment's value that are not below it."""
    near = F.array(
        *[
            value.bitwiseXOR(F.lit(sum(1 << k for k in flips)).cast("long"))
            for r in range(radius + 1)
            for flips in combinations(range(width), r)
        ]
    )
    # The number of parameters tells these functions whether an index is wanted.
    return F.transform(
        F.filter(near, lambda x: x >= value), lambda x: F.struct(F.lit(segment).alias("seg"), x.alias("key"))
    )


def links(fps: DataFrame, scratch: Scratch, distance: int = 3, segments: int = 2, hot: int = HOT) -> DataFrame:
    """``(u, v)``: links among the distinct fingerprints of ``fps(fp)`` that give the same
    components as all pairs within ``distance`` bits."""
    radius = distance // segments
    spans = _segments(segments)
    cut = [
        F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1 if w < 64 else -1).cast("long")) for a, w in spans
    ]
    entries = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(k).alias("seg"), c.alias("key")) for k, c in enumerate(cut)])).alias("e")
    ).select("e.seg", "e.key", "fp")
    crowded = scratch.store(
        entries.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot), "hot-keys"
    )
    # Of two values that differ, the smaller one probes; equal values probe each other.
    balls = F.concat(*[_ball(k, c, w, radius) for k, (c, (_, w)) in enumerate(zip(cut, spans))])
    probes = fps.select(F.col("fp").alias("probe"), F.explode(balls).alias("e")).select("e.seg", "e.key", "probe")
    near = F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= distance
    # A ball is dozens of rows for a fingerprint, which Spark's estimate takes for one: no side to broadcast.
    few = (
        entries.join(crowded, ["seg", "key"], "left_anti")
        .join(probes.hint("shuffle_merge"), ["seg", "key"])
        .where((F.col("probe") != F.col("fp")) & near)
        .select(F.col("probe").alias("u"), F.col("fp").alias("v"))
    )
    if crowded.isEmpty():
        return few
    # The fingerprints of a crowded key, and those that probe it, in blocks against blocks.
    asking = probes.withColumnRenamed("probe", "fp").join(crowded, ["seg", "key"])
    wide = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    grid = scratch.store(
        asking.groupBy("seg", "key", "n").agg(F.count("*").alias("m")).select(
            "seg", "key", wide("n").alias("rows"), wide("m").alias("cols")
        ),
        "grid",
    )
    at = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    table = entries.join(grid, ["seg", "key"]).withColumn("i", at("rows")).withColumn("j", every("cols"))
    asked = asking.drop("n").join(grid, ["seg", "key"]).withColumn("j", at("cols")).withColumn("i", every("rows"))
    both = table.select("seg", "key", "i", "j", "fp").unionByName(asked.select("seg", "key", "i", "j", "fp"))

    def forest(found):
        import pandas as pd

        x = found["fp"].to_numpy()
        return pd.DataFrame(spanning_links(x, x[:0], distance), columns=["u", "v"], dtype="int64")

    many = both.groupBy("seg", "key", "i", "j").applyInPandas(forest, "u long, v long")
    return few.unionByName(many)


def hex16(column: str):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    extra: tuple = (),
) -> DataFrame:
    """``(doc_id, fingerprint, component_id, class_fingerprint, n_documents, n_fingerprints,
    *extra)``, a row per document: 16 hex digits, the smallest id in its class, one fingerprint
    of the class (the same for all of it), and the size of the class."""
    scratch = Scratch(docs.sparkSession, "simhash")
    stored = scratch.store(fingerprints(docs, id_col, text_col, shingle, extra), "fingerprints")
    classes = scratch.store(
        stored.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct"
    )
    stars = components(links(classes.select("fp"), scratch, distance), scratch)
    rooted = classes.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    sizes = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("n_documents"), F.count("*").alias("n_fingerprints")
    )
    found = scratch.store(
        rooted.select("fp", "root").join(sizes, "root"),
        "classes",
    )
    return stored.join(found, "fp").select(
        "doc_id",
        hex16("fp").alias("fingerprint"),
        "component_id",
        hex16("root").alias("class_fingerprint"),
        "n_documents",
        "n_fingerprints",
        *[c for c in stored.columns if c not in ("doc_id", "fp")],
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each class: the one with the
    smallest id (a null id last, then by the text's hash; one of repeated rows)."""
    mark = F.xxhash64(text_col).alias("_mark")
    found = near_duplicates(docs, id_col, text_col, extra=(mark,), **settings)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_mark"))
    keepers = (
        found.groupBy("class_fingerprint")
        .agg(F.min(order).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k._mark").alias("_m"))
    )
    (own,) = unused(docs, "_m")
    marked = docs.withColumn(own, F.xxhash64(text_col))
    same = marked[id_col].eqNullSafe(keepers["_id"]) & (marked[own] == keepers["_m"])
    # A keeper for every class is no side to broadcast.
    kept = marked.join(keepers.hint("shuffle_merge"), same, "left_semi")
    return kept.dropDuplicates([id_col, own]).drop(own)
