"""Joins on tokens. Token frequencies are Zipfian: a handful of tokens can hold a third of
all rows, and the other side (a vocabulary) can outgrow any broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from opinia.session import materialize

# A lookup side is broadcast only when it is counted to have no more rows and bytes than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes, as text.

    A plain aggregate, added up in every task; ``df`` should be a stored table.
    """
    size = F.lit(0)
    for field in df.schema.fields:
        if field.dataType.simpleString() == "string":
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            size = size + 8
    rows, total = df.agg(F.count("*"), F.sum(size)).first()
    return rows <= max_rows and (total or 0) <= max_bytes


# Keys of at most so many characters, as many as that, are broadcast to drop rows without a partner.
IDLE_KEYS, IDLE_LENGTH = 100_000, 64


def drop_idle(left: DataFrame, counts: DataFrame, wanted: DataFrame, on: str, weight: str = "n") -> DataFrame:
    """``left`` without the rows of its most frequent keys that ``wanted`` lacks, before a join that would
    move them for nothing.

    ``counts`` has the rows of ``left`` by key. What is broadcast has at most ``IDLE_KEYS`` keys of
    ``IDLE_LENGTH`` characters, which is bounded whatever the data; rarer and longer keys without
    a partner are left to the join.
    """
    idle = counts.where(F.length(on) <= IDLE_LENGTH).select(on, weight)
    idle = idle.join(wanted.select(on), on, "left_anti").orderBy(F.desc(weight), on).limit(IDLE_KEYS).select(on)
    return left.join(F.broadcast(idle), on, "left_anti")


def heavy_keys(counts: DataFrame, on: Sequence[str], weight: str) -> DataFrame | None:
    """The keys that hold more than one shuffle partition's fair share of the rows, and into
    how many slices (``_slices``) to cut each; None when there is no such key.

    ``counts`` is a stored table with one row per key. With P shuffle partitions fewer than
    P keys can hold more than 1/P of the rows, and their slices add up to less than 2P, so
    the result is small enough to broadcast whatever the data.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, largest = counts.agg(F.sum(weight), F.max(weight)).first()
    if not total or largest * partitions <= total:
        return None
    share = F.col(weight) * F.lit(partitions) / F.lit(float(total))
    return counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias("_slices"))


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    heavy: DataFrame,
    spread_by: Sequence[str],
) -> DataFrame:
    """Equi-join in which rows of heavy keys are spread over slices by ``spread_by``, with
    the matching lookup rows repeated once per slice. Exact for inner, left and left_anti.

    For an inner join, heavy keys that the lookup lacks are dropped before the shuffle.
    ``heavy`` comes from :func:`heavy_keys`, which bounds the broadcast.
    """
    on = list(on)
    if how == "inner":
        idle = heavy.select(*on).join(right.select(*on), on, "left_anti")
        left = left.join(F.broadcast(idle), on, "left_anti")
    heavy = F.broadcast(heavy)
    cut = (
        left.join(heavy, on, "left")
        .withColumn(
            "_slice",
            F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int"), F.lit(0)),
        )
        .drop("_slices")
    )
    copies = (
        right.join(heavy, on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return cut.join(copies.hint("merge"), [*on, "_slice"], how).drop("_slice")


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    counts: DataFrame | None = None,
    weight: str = "n",
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join rows to a lookup table: broadcast when the lookup is counted to be small, a
    merge join otherwise, sliced where keys are heavy.

    ``counts`` is a stored table of the rows per key of ``left``; without it they are
    counted. The strategy is always named, because the optimizer takes an exploded side for
    as small as the arrays it came from and could broadcast it.
    """
    on = list(on)
    if fits(lookup, max_broadcast):
        return left.join(F.broadcast(lookup), on, how)
    if counts is None:
        counts = materialize(left.groupBy(*on).agg(F.count("*").alias("n")), "key-counts")
        weight = "n"
    heavy = heavy_keys(counts, on, weight)
    if heavy is None:
        return left.join(lookup.hint("merge"), on, how)
    return sliced_join(left, lookup, on, how, heavy, spread_by)
