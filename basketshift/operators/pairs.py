"""Pairing the items of two groups without a hot group in one task.

A group with many items is split into blocks of items by hash. The join key gets the
two block numbers, so each pair of blocks is a join of its own that lands on its own
task. A row is copied once per block of the other side: 2nm/block rows for nm pairs.
Groups within the block size have one block and are not copied. Every pair arises
exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blocks(count: Column | str, size: int) -> Column:
    return F.ceil((F.col(count) if isinstance(count, str) else count) / F.lit(float(size))).cast("int")


def _block_of(item: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(item), n).cast("int")


def _each(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def block_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_item: str, right_item: str,
               left_count: tuple[str, str], right_count: tuple[str, str], size: int) -> DataFrame:
    """Inner join on ``keys``.

    ``left_count`` names the columns of ``left`` that hold the item count of its own group
    and of the group it meets; ``right_count`` the same for ``right``. The counts may be
    larger than the rows present, never differ between the sides.
    """
    own, met = left_count
    a = left.withColumn("_lb", _block_of(left_item, blocks(own, size))).withColumn("_rb", _each(blocks(met, size)))
    own, met = right_count
    b = right.withColumn("_rb", _block_of(right_item, blocks(own, size))).withColumn("_lb", _each(blocks(met, size)))
    return a.join(b, [*keys, "_lb", "_rb"]).drop("_lb", "_rb")


def half_self_join(rows: DataFrame, keys: Sequence[str], *, item: str, count: str, values: Sequence[str], size: int) -> DataFrame:
    """Unordered pairs (item_a < item_b) within each group, once each.

    ``count`` holds the group's item count. Block pairs are unordered too, so a row is
    copied once per block of its group.
    """
    n = blocks(count, size)
    cells = (rows.withColumn("_own", _block_of(item, n)).withColumn("_other", _each(n))
             .withColumns({"_lo": F.least("_own", "_other"), "_hi": F.greatest("_own", "_other")}))
    on = [*keys, "_lo", "_hi"]

    def side(suffix):
        return cells.select(*on, *[F.col(c).alias(c + suffix) for c in [item, *values, "_own"]])

    a, b = side("_a"), side("_b")
    # Two items of one block meet only in that block's own cell.
    once = (F.col("_lo") == F.col("_hi")) | (F.col("_own_a") != F.col("_own_b"))
    return a.join(b, on).where((F.col(item + "_a") < F.col(item + "_b")) & once).drop("_lo", "_hi", "_own_a", "_own_b")


def neighbour_join(rows: DataFrame, keys: Sequence[str], order: str, *, item: str, values: Sequence[str], size: int) -> DataFrame:
    """Pairs of items of one group, and of a group and the one before it, from a single join.

    Groups are numbered by ``order`` within ``keys``. ``rows`` has item_count, prev_count and next_count: the items of the row's own group, and
    of the groups before and after it (null if there is none). A row meets its own group and the ones beside it: it is tagged with the number of the later group
    of each meeting. Of a group and the one before, every pair arises once, with the later group's item on side _a. Of one group, each two
    items arise once, the smaller one on side _a. ``_adjacent`` tells which it is.
    """
    own, before, after = (blocks(c, size) for c in ("item_count", "prev_count", "next_count"))
    mine, none = F.col("_own"), F.array().cast("array<struct<_at:int,_adjacent:boolean,_x:int,_y:int>>")
    number = F.col(order).cast("int")

    def cells(n: Column, cell) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), cell)

    def tag(at, adjacent, x, y):
        return F.struct(at.alias("_at"), F.lit(adjacent).alias("_adjacent"), x.cast("int").alias("_x"), y.cast("int").alias("_y"))

    within = F.when(F.col("item_count") > 1, cells(own, lambda o: tag(number, False, F.least(mine, o), F.greatest(mine, o)))).otherwise(none)
    later = F.when(before.isNotNull(), cells(before, lambda o: tag(number, True, mine, o))).otherwise(none)
    earlier = F.when(after.isNotNull(), cells(after, lambda o: tag(number + 1, True, o, mine))).otherwise(none)
    placed = rows.withColumn("_own", _block_of(item, own))
    on = [*keys, "_at", "_adjacent", "_x", "_y"]

    def side(tags, suffix):
        met = placed.withColumn("_tag", F.explode(tags))
        return met.select(*keys, "_tag.*", *[F.col(c).alias(c + suffix) for c in [item, *values, "_own"]])

    a, b = side(F.concat(within, later), "_a"), side(F.concat(within, earlier), "_b")
    # Two items of one block meet only in that block's own cell.
    once = (F.col(item + "_a") < F.col(item + "_b")) & ((F.col("_x") == F.col("_y")) | (F.col("_own_a") != F.col("_own_b")))
    return a.join(b, on).where(F.col("_adjacent") | once).drop("_x", "_y", "_own_a", "_own_b")
