"""What the operators share: words, splits by id, scratch tables, prefix sums."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def split_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text. ``bytes.split`` cuts at exactly :data:`BLANKS`."""
    return text.split()


def word_count(column: str) -> Column:
    """Number of words, as a long, without a Python worker: the words that begin somewhere."""
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.regexp_count(F.col(column), F.lit(WORD))).cast("long")


def bucket(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session, ``spark.checkpoint.dir``.

    Where it is unset, a session on a local master gets a temporary folder (tests do); any
    other master has no folder that all executors see, which is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return str(configured).rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"opinia-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


class Scratch:
    """Tables that one call of an operator writes once and reads several times.

    They cut lineage and outlive lost executors. ``drop`` removes one as soon as nothing
    reads it any more; what the returned DataFrame reads stays for the caller's action.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = path
        stored._scratch_path = path
        return stored

    def drop(self, stored: DataFrame) -> None:
        self.drop_path(stored._scratch_path)

    def drop_path(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(
    df: DataFrame, order: Sequence[str], sums: dict[str, str], scratch: Scratch, name: str = "ordered"
) -> DataFrame:
    """For each row, the sums of columns over all *earlier* rows in the order of ``order``.

    Rows are split into ranges of the order and written once; the totals of the ranges (one
    row each) are added up ahead of the running sums inside each range. No task sees more
    than one range. ``order`` should be total but for rows that are equal throughout, or
    rows of one range could not be told apart.
    """
    parts = shuffle_partitions(df.sparkSession)
    ranged = scratch.store(
        df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), name
    )
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "_range").select(
        *df.columns,
        *[
            (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out)
            for c, out in sums.items()
        ],
    )


def with_next(df: DataFrame, order: Sequence[str], scratch: Scratch, name: str = "ordered") -> DataFrame:
    """``df`` with ``next``, the ``order`` columns of the row that follows (null after the last).

    Rows are split into ranges of the order, as in :func:`prefix_sums`; the last row of a range
    is followed by the first of the next one that has rows.
    """
    parts = shuffle_partitions(df.sparkSession)
    ranged = scratch.store(
        df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), name
    )
    whole = F.struct(*order)
    behind = Window.partitionBy(F.lit(0)).orderBy("_range")
    firsts = ranged.groupBy("_range").agg(F.min(whole).alias("_first"))
    firsts = firsts.select("_range", F.lead("_first").over(behind).alias("_behind"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return ranged.withColumn("next", F.lead(whole).over(inside)).join(firsts, "_range").select(
        *df.columns, F.coalesce("next", "_behind").alias("next")
    )


#: The struct column in which a whole row is carried through a Python task.
ROW = "_row"


def whole_row(df: DataFrame) -> Column:
    """All columns in one, so that their names do not matter."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def texts_of(batch, carried: str | None) -> list[bytes]:
    """The UTF-8 texts of a batch: of ``_text``, or of this field of the carried row, so that the
    text is not sent twice. Null counts as empty."""
    import pyarrow as pa

    if carried is None:
        return batch.column("_text").to_pylist()
    column = batch.column(ROW).field(batch.column(ROW).type.get_field_index(carried))
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def release() -> None:
    """Gives memory that Arrow and the C library keep for later back at the end of a task, since a
    worker goes on to serve other stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def parts_by_bytes(batch, sizes, most_rows: int, most_bytes: int):
    """A batch in slices of at most so many rows and, but for single rows, so many bytes."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if k > start and (k - start >= most_rows or held + size > most_bytes):
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, made of these."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
