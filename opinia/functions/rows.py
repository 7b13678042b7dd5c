"""Arrays to rows.

The inner generators make the optimizer add a ``size(array) > 0`` filter below them, which
computes the array a second time (and moves that work below a repartition, next to the
scan). The outer generators do not, so these helpers use them and drop the row that stands
for an empty array afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode(df: DataFrame, keep: Sequence[str], values: Column | str, name: str) -> DataFrame:
    """One row per non-null value."""
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())


def posexplode(df: DataFrame, keep: Sequence[str], values: Column | str, pos: str, name: str) -> DataFrame:
    """One row per non-null value, with its position from 0."""
    return df.select(*keep, F.posexplode_outer(values).alias(pos, name)).where(F.col(name).isNotNull())


def inline(df: DataFrame, keep: Sequence[str], structs: Column | str, key: str) -> DataFrame:
    """One row per struct, its fields as columns; ``key`` is a field that is never null."""
    return df.select(*keep, F.inline_outer(structs)).where(F.col(key).isNotNull())
