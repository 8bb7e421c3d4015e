"""Baskets: one customer's purchases at one time, numbered in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import prefix
from basketshift.session import stage

USER = ["scope_id", "user_id"]


def basket_key(by_day: bool) -> list[str]:
    """Columns that tell a customer's baskets apart, in basket order."""
    return ["sale_ord_dt"] if by_day else ["sale_ord_tm", "parent_sale_ord_id"]


def purchases(lines: DataFrame, by_day: bool) -> DataFrame:
    """Lines summed to (customer, basket, item).

    This shuffle carries the item in its key, so no customer or order is hot in it, and
    repeated lines collapse before it.
    """
    if not by_day:
        lines = lines.withColumn("sale_ord_tm", C.to_second("sale_ord_tm"))
    keys = USER + basket_key(by_day) + ["item_id"]
    sums = [F.sum(C.scaled("sale_qtty")).alias("qty"), F.sum(C.scaled("before_prefr_amount")).alias("amount")]
    return lines.groupBy(*keys).agg(*sums)


def number_baskets(rows: DataFrame, by_day: bool) -> DataFrame:
    """Adds seqnum: 1..n over a customer's baskets."""
    order = Window.partitionBy(*USER).orderBy(*basket_key(by_day))
    return rows.withColumn("seqnum", F.dense_rank().over(order))


def basket_totals(rows: DataFrame) -> DataFrame:
    """Adds the amount and the number of items of the basket."""
    basket = Window.partitionBy(*USER, "seqnum")
    return rows.withColumns({"basket_amount": F.sum("amount").over(basket), "item_count": F.count(F.lit(1)).over(basket)})


def neighbours(rows: DataFrame) -> DataFrame:
    """Adds the item counts of the baskets before and after, and of the customer's largest.

    A null count says that there is no such basket.
    """
    near = Window.partitionBy(*USER).orderBy("seqnum")
    return rows.withColumns({
        "prev_count": F.max("item_count").over(near.rangeBetween(-1, -1)),
        "next_count": F.max("item_count").over(near.rangeBetween(1, 1)),
        "largest": F.max("item_count").over(Window.partitionBy(*USER)),
    })


def spread_baskets(rows: DataFrame, by_day: bool) -> DataFrame:
    """Adds all that ``number_baskets``, ``basket_totals`` and ``neighbours`` do, for customers of any size.

    Baskets are summed up by themselves, numbered in range slices, and looked up by their numbers, so no step brings a
    customer's rows together. Only the largest basket goes back by customer, where adaptive execution can split one with many rows.
    """
    key = basket_key(by_day)
    totals = rows.groupBy(*USER, *key).agg(F.sum("amount").alias("basket_amount"), F.count(F.lit(1)).alias("item_count"))
    numbered = stage(prefix.number_within(totals, USER, [F.col(c) for c in key], "seqnum"), "numbered")
    counts = numbered.select(*USER, "seqnum", "item_count")

    def beside(step: int, name: str) -> DataFrame:
        return counts.select(*USER, (F.col("seqnum") + step).alias("seqnum"), F.col("item_count").alias(name))

    found = numbered.join(beside(1, "prev_count"), [*USER, "seqnum"], "left").join(beside(-1, "next_count"), [*USER, "seqnum"], "left")
    largest = counts.groupBy(*USER).agg(F.max("item_count").alias("largest"))
    known = found.select(*[F.col(c).alias(f"_{c}") for c in [*USER, *key]], *[c for c in found.columns if c not in (*USER, *key)])
    # A basket of a day has no order: such keys are null on both sides.
    same = [rows[c].eqNullSafe(known[f"_{c}"]) if c == "parent_sale_ord_id" else rows[c] == known[f"_{c}"] for c in [*USER, *key]]
    return rows.join(known, same).drop(*[f"_{c}" for c in [*USER, *key]]).join(largest, USER)


# Orders of a customer up to which windows by customer are used: their rows are bounded by this times the items of a scope.
WINDOW_ORDERS = 10_000


def basket_rows(rows: DataFrame, by_day: bool, most_orders: int = WINDOW_ORDERS) -> DataFrame:
    """The basket table of ``purchases`` of customers within the order limits.

    Where the limits bound a customer's rows, windows by customer share one partitioning. Where they do not, baskets are spread.
    """
    order = [] if by_day else ["parent_sale_ord_id"]
    found = spread_baskets(rows, by_day) if most_orders > WINDOW_ORDERS else neighbours(basket_totals(number_baskets(rows, by_day)))
    return found.select(
        *USER, "seqnum", "item_id", "qty", "amount", "basket_amount", "item_count", "prev_count", "next_count", "largest", *order)
