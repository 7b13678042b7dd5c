"""Running sums and ranks over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.session import materialize


def running_sums(
    df: DataFrame, order: Sequence[Column], sums: dict[str, str], name: str, group: Sequence[str] = ()
) -> DataFrame:
    """For each row, the sums of columns over all *earlier* rows of its group in a total order.

    ``sums`` maps a numeric column to the name of its running sum; without ``group`` the whole table
    is one group, and null is a group like others. The rows are split into ranges of the group and the
    order and written once, so that the ranges cannot differ between the two reads that follow.
    Each range holds the end of one group, whole groups, and the beginning of another: the
    totals of a group by range, one small row each, are summed up ahead of the running sums
    inside each range. No task sees more than one range, however the rows fall into groups.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    ranged = materialize(
        df.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id()), name
    )
    totals = ranged.groupBy("_range", *group).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # A group's rows here are the ranges it runs over, `parts` at most.
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_r"),
        *[F.col(c).alias(f"_g_{c}") for c in group],
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    same = F.col("_range") == F.col("_r")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Without groups there is a row for each range; with them, there can be many.
    return ranged.join(offsets if group else F.broadcast(offsets), same).select(
        *df.columns,
        *[
            (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out)
            for c, out in sums.items()
        ],
    )
