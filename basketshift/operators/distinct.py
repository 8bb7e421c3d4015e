"""Exact distinct counts that merge: dense numbers for values, and bitmaps of the numbers by group.

A bitmap covers 32,768 numbers in 4 KB. Numbers are given in order of arrival, so what first comes in one month has neighbouring
numbers and fills its bitmaps. Counts over several months, or over several groups, are unions of bitmaps; no value is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.session import stage

NUMBERED = "value string, number bigint"


def dense_numbers(values: DataFrame, after: int = 0) -> DataFrame:
    """value and number: the distinct values without null, numbered after + 1, after + 2, ... in their order.

    Range slices that are numbered by themselves, and one offset per slice.
    """
    cut = stage(values.where("value is not null").select("value").distinct().repartitionByRange("value").withColumn("_slice", F.spark_partition_id()),
                "slices")
    sizes = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy("value"))
    return cut.withColumn("_number", inside).join(F.broadcast(offsets), "_slice").select(
        "value", (F.lit(after) + F.col("_before") + F.col("_number")).cast("bigint").alias("number"))


def number_new(known: DataFrame, values: DataFrame) -> DataFrame:
    """Numbers of the values that ``known`` lacks, behind its largest. Numbers that were given stay."""
    last = known.agg(F.max("number")).first()[0]
    return dense_numbers(values.select("value").distinct().join(known, "value", "left_anti"), last or 0)


def bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, bucket and bits: the set of ``number`` of each group."""
    return rows.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged_count(sets: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct numbers per group, over all the bitmaps that it has."""
    joined = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))
