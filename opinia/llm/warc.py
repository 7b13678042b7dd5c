"""WARC archives: writing records, and reading them by a verified chain of boundaries.

Archives are read in splits, cut at every occurrence of the magic ``WARC/1.``, wherever it
stands. Each occurrence is a candidate: if a header with a length follows, it tells where its
successor would begin. A record is real only if the chain of successors from the start of its
file reaches it; the magic inside a payload, or a whole record quoted in one, is not reached.

First pass: each task follows the candidates of its split up to the first successor outside of
it, and emits that hop for every candidate. The offset of a split is the sum of the lengths
before it in the file. Pointer jumping from offset 0 then doubles the hops each round, so a
file of n splits takes log2(n) rounds over tables of numbers, and tells where the chain enters
each split. Second pass: tasks walk their splits from there; whatever lies between
a record's start and its end is its content. A record that runs over splits is put together
from its pieces, which are few: at most one record begins and does not end in a split.

Payloads are written once and never shuffled, but for the pieces just named, and one payload of each
group of rows that are alike in id, url and payload. Broadcast: 24 bytes a split, of at most
``MOST_SPLITS`` splits at once.

Defined results: a null html is an empty payload; a null url is an empty target; a null page id
is written as an empty one and read back as null; of repeated rows with a payload of at least
``least`` bytes one is the response; a header whose length has more than 18 digits is none, so it
is passed over in a payload like any other magic; an empty table writes and reads no records; an archive
whose chain does not end at the end of the file raises an error, as does one with the magic in a
header (written targets have it escaped); other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinia.llm.common import Scratch

MAGIC = b"WARC/1."
END = "\r\n\r\n"
#: Lengths of more digits are none that a file could have.
LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", re.IGNORECASE)
#: Splits (2 PB of 128 MB each) whose places, 24 bytes of each, are broadcast at once; more are read in
#: turns, by file.
MOST_SPLITS = 16_000_000
FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Refers-To", "WARC-Payload-Digest")


def _lines(*lines: Column | str) -> Column:
    return F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in lines])


def _id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def as_records(
    pages: DataFrame, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
    least: int = 1000, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """``pages`` as one string ``record`` a row, without the end that follows each record.

    Of records with equal payloads of at least ``least`` bytes, that with the largest id is a
    response and the others revisit it.
    """
    base = pages.select(
        F.col(id_col).alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.coalesce(F.col(text_col), F.lit("")).alias("payload"),
    )
    base = base.withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload")})
    # Only digests that come twice are looked up; with few of them, payloads are not shuffled. The
    # response has the largest id and, of equal ids, the largest url; ``alike`` rows have both.
    again = scratch.store(
        base.where(F.col("bytes") >= least)
        .groupBy("digest", "bytes", "id", "url")
        .agg(F.count("*").alias("alike"))
        .groupBy(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"))
        .agg(F.max(F.struct("id", "url", "alike")).alias("top"), F.sum("alike").alias("n"))
        .where("n > 1")
        .select("_digest", "_bytes", F.col("top.id").alias("first"), F.col("top.url").alias("first_url"), "top.alike"),
        "equal-payloads",
    )
    known = base.join(again, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    is_top = F.col("id").eqNullSafe(F.col("first")) & (F.col("url") == F.col("first_url"))
    later = F.col("alike").isNotNull() & ~is_top
    if not again.where("alike > 1").isEmpty():
        # Of rows that are alike throughout, one is made anew with its payload, and the others without.
        twin = (F.coalesce("alike", F.lit(0)) > 1) & is_top
        columns = [c for c in known.columns if c != "payload"]
        once = known.where(twin).groupBy(*columns).agg(F.any_value("payload").alias("payload"))
        copies = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "alike")))
        one = F.col("copy") == 1
        copies = copies.withColumn("payload", F.when(one, F.col("payload")).otherwise(F.lit("")))
        known = known.where(~twin).withColumn("repeats", F.lit(False)).unionByName(
            copies.withColumn("repeats", ~one).drop("copy")
        )
        later = later | F.col("repeats")
    http = _lines(
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("bytes").cast("string"), END
    )
    plain = F.regexp_replace("url", "WARC/1", "WARC%2F1")
    marked = known.withColumns({"later": later, "http": http})
    block = F.when(F.col("later"), F.col("http")).otherwise(F.concat("http", "payload"))
    refers = _lines(
        "WARC-Refers-To: ", _id("first"),
        "\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n",
    )
    record = _lines(
        "WARC/1.1\r\nWARC-Type: ", F.when(F.col("later"), "revisit").otherwise("response"),
        "\r\nWARC-Record-ID: ", _id("id"), f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: ", plain,
        "\r\nWARC-Payload-Digest: sha1:", F.col("digest"), "\r\n", F.when(F.col("later"), refers).otherwise(F.lit("")),
        "Content-Type: application/http; msgtype=response\r\nContent-Length: ", F.octet_length(block).cast("string"), END,
        block,
    )
    return marked.select(record.alias("record"))


def write_warc(pages: DataFrame, folder: str, scratch: Scratch, **settings) -> None:
    """Archives of the pages' records, one file a partition."""
    as_records(pages, scratch, **settings).write.option("lineSep", END).text(folder)


def fragments(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between occurrences of the magic, in the order of the file within each split."""
    return (
        spark.read.option("lineSep", MAGIC.decode())
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def record_length(fragment: bytes) -> tuple[int, int] | None:
    """Bytes of the header and of the content of a record that begins with the magic and
    ``fragment``; None if no header follows."""
    if fragment[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    end = fragment.find(b"\r\n\r\n")
    found = LENGTH.search(fragment, 0, end + 2) if end >= 0 else None
    return (len(MAGIC) + end + 4, int(found[1])) if found else None


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, place in the split, fragment); the magic before a fragment is part of it, so
    the place of the first fragment of a file is -7."""
    at: tuple | None = None
    place = 0
    for b in batches:
        for file, block, value in zip(*(b.column(c).to_pylist() for c in ("file", "block", "value"))):
            if (file, block) != at:
                at, place = (file, block), -len(MAGIC) if block == 0 else 0
            yield file, block, place, value
            place += len(value) + len(MAGIC)


HOPS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("leaves", pa.int64())])


def hops(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each candidate of a split the place at which its chain leaves the split, and a last row
    (null place) with the length of the split."""

    def out(file: str, block: int, places: list[int], after: list[int], length: int) -> pa.RecordBatch:
        known = {p: k for k, p in enumerate(places)}
        leaves = after[:]
        for k in range(len(places) - 1, -1, -1):  # successors lie ahead, so theirs are known
            leaves[k] = leaves[known[after[k]]] if after[k] in known else after[k]
        n = len(places) + 1
        columns = ([file] * n, [block] * n, [*places, None], [*leaves, length])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HOPS)], schema=HOPS)

    now, places, after, length = None, [], [], 0
    for file, block, place, value in _splits(found):
        if (file, block) != now:
            if now:
                yield out(*now, places, after, length)
            now, places, after = (file, block), [], []
        size = record_length(value)
        if size:
            places.append(place)
            after.append(place + sum(size) + len(END))
        length = place + len(value) + len(MAGIC)
    if now:
        yield out(*now, places, after, length)


def entries(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    """``(file, block, base, entry)``: where each split begins in its file, and the first place in
    it that the chain from the file's start reaches (null for none)."""
    found = scratch.store(
        fragments(spark, folder).mapInArrow(hops, "file string, block long, place long, leaves long"), "hops"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.store(
        found.where("place IS NULL").select(
            "file", "block", "leaves", F.coalesce(F.sum("leaves").over(before), F.lit(0)).alias("base")
        ),
        "bases",
    )
    jump = scratch.store(
        found.where("place IS NOT NULL")
        .join(bases.drop("leaves"), ["file", "block"])
        .select("file", (F.col("base") + F.col("place")).alias("at"), (F.col("base") + F.col("leaves")).alias("to")),
        "jumps",
    )
    ends = bases.groupBy("file").agg(F.max(F.col("base") + F.col("leaves")).alias("end"))
    reached = jump.where("at = 0").select("file", "at")
    fresh = reached
    while True:
        more = scratch.store(fresh.join(jump, ["file", "at"]).select("file", F.col("to").alias("at")), "reached")
        reached = scratch.store(reached.unionByName(more), "reached")
        there = jump.select("file", F.col("at").alias("to"), F.col("to").alias("next"))
        jump = scratch.store(jump.join(there, ["file", "to"]).select("file", "at", F.col("next").alias("to")), "jumps")
        if jump.isEmpty():
            break
        fresh = reached
    last = reached.groupBy("file").agg(F.max("at").alias("reach"))
    broken = ends.join(last, "file", "left").where(~F.col("reach").eqNullSafe(F.col("end")))
    bad = broken.select("file").limit(3).collect()
    if bad:
        raise ValueError(f"the records of {[r['file'] for r in bad]} do not follow each other to the end")
    inside = reached.join(bases, "file").where("at >= base AND at < base + leaves")
    first = inside.groupBy("file", "block").agg(F.min(F.col("at") - F.col("base")).alias("entry"))
    return bases.drop("leaves").join(first, ["file", "block"], "left")


def split_key(file: str, block: int) -> int:
    """What ``xxhash64`` makes of the block and the file."""
    key = xxhash.xxh64_intdigest(f"{block} {file}".encode(), 42)
    return key - (1 << 64) if key >> 63 else key


PIECES = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("header", pa.int64()), ("data", pa.binary())]
)


def walk(found: Iterator[pa.RecordBatch], keys: np.ndarray, bases: np.ndarray, firsts: np.ndarray):
    """Rows (file, offset, size, header, data) of the records that begin in a split, from its entry
    on; ``data`` is shorter than ``size`` if a record runs on. What precedes the entry comes with
    a null size."""
    rows: list[tuple] = []
    held = 0
    now, base, expected, open_ = None, 0, 0, None

    def done(row: tuple) -> None:
        nonlocal held
        file, offset, size, header, parts = row
        data = b"".join(parts)[: size if size is not None else None]
        rows.append((file, offset, size, header, data))
        held += len(data)

    def flush() -> pa.RecordBatch:
        nonlocal held
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)
        rows.clear()
        held = 0
        return out

    for file, block, place, value in _splits(found):
        if (file, block) != now:
            if open_:
                done(open_)
                open_ = None
            now = (file, block)
            at = int(np.searchsorted(keys, split_key(file, block)))
            base, expected = int(bases[at]), int(firsts[at])
        if place == expected and (size := record_length(value)):
            if open_:
                done(open_)
            open_ = (file, base + place, sum(size), size[0], [MAGIC, value])
            expected = place + sum(size) + len(END)
        elif open_:
            open_[4].extend((MAGIC, value))
        elif place >= 0:
            done((file, base + place, None, None, [MAGIC, value]))
        if held > 1 << 23:
            yield flush()
    if open_:
        done(open_)
    if rows:
        yield flush()


def parse(record: bytes, header: int) -> tuple:
    """The fields, the payload's length by its own header, and the payload (None for a revisit)."""
    head, block = record[:header].decode("utf-8", "replace"), record[header:]
    fields = {}
    for line in head.split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    values = [fields.get(f.lower()) for f in FIELDS]
    length, payload = None, block
    if block[:5] == b"HTTP/":
        end = block.find(b"\r\n\r\n")
        told = LENGTH.search(block, 0, end + 2)
        length, payload = int(told[1]) if told else None, block[end + 4 :]
    if values[0] == "revisit":
        payload = None
    elif length is None:
        length = len(payload)
    return (*values, length, payload)


RECORDS = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
     ("date", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("payload_length", pa.int64()),
     ("payload", pa.binary())]
)


def read_warc(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    """The records of all archives: file, offset, type, record_id, uri, date, refers_to, digest,
    payload_length and payload."""
    at = scratch.store(entries(spark, folder, scratch), "entries")
    turns = -(-at.count() // MOST_SPLITS) or 1
    found = [_read_turn(spark, folder, scratch, at, turn, turns) for turn in range(turns)]
    records = found[0]
    for more in found[1:]:
        records = records.unionByName(more)
    return records


def _read_turn(spark: SparkSession, folder: str, scratch: Scratch, at: DataFrame, turn: int, turns: int) -> DataFrame:
    """The records of the files of one turn."""
    mine = F.pmod(F.xxhash64("file"), F.lit(turns)) == turn
    at = at.where(mine)
    key = F.xxhash64(F.concat(F.col("block").cast("string"), F.lit(" "), F.col("file")))
    known = at.select(key.alias("key"), "base", F.coalesce("entry", F.lit(-1 << 40)).alias("entry")).toArrow()
    keys, bases, firsts = (known.column(c).to_numpy() for c in ("key", "base", "entry"))
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], bases[order], firsts[order]))

    def records(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out = list(rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RECORDS)], schema=RECORDS)

    def whole(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for b in walk(batches, *shared.value):
            rows = zip(*(b.column(c).to_pylist() for c in PIECES.names))
            if wanted:
                yield from records((f, o, *parse(d, h)) for f, o, s, h, d in rows if s is not None and len(d) == s)
            else:
                out = [r for r in rows if r[2] is None or len(r[4]) < r[2]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)], schema=PIECES)

    schema = "file string, offset long, type string, record_id string, uri string, date string, refers_to string, digest string, payload_length long, payload binary"
    source = fragments(spark, folder).where(mine)
    found = source.mapInArrow(lambda b: whole(b, True), schema)
    # A record runs over splits where a later split does not begin with an entry.
    if at.where("block > 0 AND NOT entry <=> 0").isEmpty():
        return found
    pieces = scratch.store(
        source.mapInArrow(lambda b: whole(b, False), "file string, offset long, size long, header long, data binary"), "pieces"
    )
    # Pieces belong to the record that was open when they came.
    so_far = Window.partitionBy("file").orderBy("offset")
    owned = pieces.withColumn("owner", F.last(F.when(F.col("size").isNotNull(), F.col("offset")), True).over(so_far))
    joined = owned.groupBy("file", "owner").agg(
        F.max("size").alias("size"), F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("offset", "data"))).alias("parts")
    )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("file", "owner", "size", "header", "parts")))
            yield from records(
                (f, o, *parse(b"".join(p["data"] for p in parts)[:s], h)) for f, o, s, h, parts in rows if o is not None
            )

    return found.unionByName(joined.mapInArrow(together, schema))
