"""Running totals inside a group that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketshift.session import stage


def running_total(df: DataFrame, group: str, order: Sequence[Column], value: str, out: str, total: str) -> DataFrame:
    """Adds the running total of ``value`` in ``order`` within ``group``, and the group total.

    A range partitioning on (group, order) cuts each group into consecutive slices that
    different tasks hold. The slice sums are few (at most one per task plus one per
    group), so their prefix sums are offsets that can be broadcast; inside a slice an
    ordinary window finishes the total. The slices are written once, so that both uses
    see the same cut.
    """
    cut = stage(df.repartitionByRange(F.col(group), *order).withColumn("_slice", F.spark_partition_id()), "slices")
    sums = cut.groupBy(group, "_slice").agg(F.sum(value).alias("_sum"))
    by_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("_sum").over(by_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(group, "_slice", before.alias("_before"), F.sum("_sum").over(by_group).alias(total))
    inside = Window.partitionBy(group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (cut.withColumn("_slice_run", F.sum(value).over(inside))
            .join(F.broadcast(offsets), [group, "_slice"])
            .withColumn(out, F.col("_before") + F.col("_slice_run")).drop("_slice", "_before", "_slice_run"))


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Numbers the rows of each group 1..n in ``order``, which tells all of a group's rows apart, whatever the size of a group.

    Range slices as above. A slice begins with at most one group that earlier slices hold a part of, so there are no more offsets than
    slices, and all other groups need none.
    """
    cut = stage(df.repartitionByRange(*map(F.col, group), *order).withColumn("_slice", F.spark_partition_id()), "slices")
    sizes = cut.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*group, "_slice", before.alias("_before")).where("_before > 0")
    inside = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
    return (cut.withColumn("_number", inside).join(F.broadcast(offsets), [*group, "_slice"], "left")
            .withColumn(out, (F.coalesce("_before", F.lit(0)) + F.col("_number")).cast("int")).drop("_slice", "_before", "_number"))
