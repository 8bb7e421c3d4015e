"""Order lines in scope: customers, long tail, item mapping, eligibility, line filters.

The order of the stages matters: customers are counted before the tail is cut, items
are judged before customers are filtered.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import prefix
from basketshift.params import Params
from basketshift.sources.readers import order_scan

# A customer outside the limits who holds more than one line in this many is dropped
# before lines are shuffled. At most this many customers can qualify.
HOT_CUSTOMERS = 10_000

ANONYMOUS = "-1"


def scope_facts(lines: DataFrame, member: DataFrame, p: Params) -> DataFrame:
    """Order lines of the window, once per scope that holds their sku."""
    df = order_scan(lines, p.start_date, p.end_date)
    return df.select("user_id", "parent_sale_ord_id", "item_sku_id", "sale_ord_tm", "sale_ord_dt", "sale_qtty",
                     "before_prefr_amount", "after_prefr_amount").join(member, "item_sku_id")


def windowed_facts(lines: DataFrame, member: DataFrame, scopes: DataFrame) -> DataFrame:
    """Order lines, once per scope that holds their sku and whose own window holds their day.

    The members take their scope's window along, two days a row, and the day decides after the join by sku. Cutting windows into months would
    multiply the members by the months of their windows, which is more rows than there are lines. The scan reads what any window covers.
    """
    first, last = scopes.agg(F.min("start_date"), F.max("end_date")).first()
    if first is None:
        first, last = date(1970, 1, 2), date(1970, 1, 1)
    known = member.join(scopes.select("scope_id", "start_date", "end_date"), "scope_id")
    df = order_scan(lines, first, last).select("user_id", "parent_sale_ord_id", "item_sku_id", "sale_ord_tm", "sale_ord_dt", "sale_qtty",
                                               "before_prefr_amount", "after_prefr_amount")
    return df.join(known, "item_sku_id").where(F.col("sale_ord_dt").between(F.col("start_date"), F.col("end_date"))).drop("start_date", "end_date")


def customer_orders(facts: DataFrame) -> DataFrame:
    """Distinct parent orders, and lines, per customer."""
    return facts.groupBy("scope_id", "user_id").agg(
        F.countDistinct("parent_sale_ord_id").alias("ord_qtty"), F.count(F.lit(1)).alias("n_lines"))


def _within_limits(p: Params):
    return F.col("ord_qtty").between(p.min_baskets, p.max_baskets)


def known_user():
    return F.col("user_id").isNotNull() & (F.col("user_id") != ANONYMOUS)


def customer_filter(lines: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Lines of known customers whose order count lies within the limits (both inclusive)."""
    keep = customers.where(_within_limits(p)).select("scope_id", "user_id")
    return lines.where(known_user()).join(keep, ["scope_id", "user_id"], "left_semi")


def drop_hot_strangers(lines: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Drop, without a shuffle, lines that ``customer_filter`` would drop after one.

    Only customers who hold more than 1/HOT_CUSTOMERS of all lines are listed, so the
    broadcast has at most HOT_CUSTOMERS rows whatever the size of the data.
    """
    total = customers.agg(F.sum("n_lines")).scalar()
    hot = customers.where(~_within_limits(p) & (F.col("n_lines") * HOT_CUSTOMERS > total)).select("scope_id", "user_id")
    return lines.where(known_user()).join(F.broadcast(hot), ["scope_id", "user_id"], "left_anti")


def positive_filter(lines: DataFrame) -> DataFrame:
    """Lines whose quantity and amount are positive at the scale at which they are summed."""
    return lines.where((C.scaled("sale_qtty") > 0) & (C.scaled("before_prefr_amount") > 0))


def nonpromo_filter(lines: DataFrame, ratio: str | Column = "0.95") -> DataFrame:
    """Positive lines sold at no less than ``ratio`` of the list amount. A null ratio lets no line pass."""
    floor = (F.lit(ratio) if isinstance(ratio, str) else ratio).cast("decimal(12,10)") * F.col("before_prefr_amount")
    return positive_filter(lines).where(F.col("after_prefr_amount") >= floor)


def sku_daily(facts: DataFrame) -> DataFrame:
    """Quantity and list amount per sku and day, scaled.

    The long tail, the items' eligibility and the skus in scope are all functions of this
    table, so none of them moves order lines.
    """
    return facts.groupBy("scope_id", "item_sku_id", "sale_ord_dt").agg(
        F.sum(C.scaled("sale_qtty")).alias("qty"), F.sum(C.scaled("before_prefr_amount")).alias("amount"))


def ranked_skus(daily: DataFrame) -> DataFrame:
    """Every sku with its quantity and the running share of its scope, by quantity from the top. Ties are ordered by sku."""
    qty = daily.groupBy("scope_id", "item_sku_id").agg(F.sum("qty").alias("_qty"))
    ranked = prefix.running_total(qty, "scope_id", [F.col("_qty").desc(), F.col("item_sku_id")], "_qty", "_run", "_total")
    return ranked.select("scope_id", "item_sku_id", C.units("_qty").alias("sale_qtty"), F.try_divide("_run", "_total").alias("cum_ratio"))


def prod_tail(daily: DataFrame, share: float) -> DataFrame:
    """Skus, by quantity from the top, whose running share of the scope is at most ``share``. The sku that crosses it is left out."""
    return ranked_skus(daily).where(F.col("cum_ratio") <= share)


def kept_skus(daily: DataFrame, p: Params) -> DataFrame:
    """(scope_id, item_sku_id) after the tail cut."""
    if p.prod_tail >= 1:
        return daily.select("scope_id", "item_sku_id").distinct()
    return prod_tail(daily, p.prod_tail).select("scope_id", "item_sku_id")


# -- item mapping -------------------------------------------------------------


def brand_attributes(attrs: DataFrame) -> DataFrame:
    """Brand rows of our own sites."""
    return attrs.where((F.col("web_id") < C.FOREIGN_SITE) & (F.col("attr_name") == C.BRAND_ATTR))


def brand_map(attrs: DataFrame, brands: DataFrame) -> DataFrame:
    """sku → (brand name, brand id). One name per sku, one id per name: the smallest."""
    named = (brand_attributes(attrs).groupBy(F.col("sku_id").alias("item_sku_id"))
             .agg(F.min("attr_value").alias("item_name")))
    ids = brands.where(F.col("brand_id").isNotNull() & F.col("brand_name").isNotNull())
    ids = ids.groupBy(F.col("brand_name").alias("item_name")).agg(F.min("brand_id").alias("item_id"))
    return named.join(ids, "item_name", "left").select("item_sku_id", "item_name", "item_id")


def with_items(skus: DataFrame, p: Params, brand: DataFrame | None = None) -> DataFrame:
    """Adds item_id: the sku itself, or its brand, null where that is unknown."""
    if p.item_type == "sku":
        return skus.withColumn("item_id", F.col("item_sku_id"))
    return skus.join(brand.select("item_sku_id", "item_id", "item_name"), "item_sku_id", "left")


def map_items(rows: DataFrame, kept: DataFrame, *more: str) -> DataFrame:
    """Rows of the kept skus with their item: tail cut and mapping in one join.

    ``kept`` has scope_id, item_sku_id, item_id, and ``more`` columns to take over. Rows without an item are dropped.
    """
    known = kept.where(F.col("item_id").isNotNull()).select("scope_id", "item_sku_id", "item_id", *more)
    return rows.join(known, ["scope_id", "item_sku_id"])


def map_skus(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``map_items`` of daily sales where every item is its sku: they move by sku once, for the join and for all that is grouped by item next."""
    moved = rows.repartition("scope_id", "item_sku_id")
    return moved.join(kept.select("scope_id", "item_sku_id"), ["scope_id", "item_sku_id"]).withColumn("item_id", F.col("item_sku_id"))


def sku_in_scope(kept: DataFrame, p: Params, skus: DataFrame) -> DataFrame:
    """The skus behind each item, over the skus left by the tail cut (with their items).

    In brand mode a sku without a known brand keeps its row with a null item.
    """
    named = kept if p.item_type == "brand" else kept.join(skus.select("item_sku_id", F.col("sku_name").alias("item_name")), "item_sku_id")
    return named.select("scope_id", "item_sku_id", "item_id", "item_name", F.lit(p.item_type).alias("item_type")).distinct()


def log_sku_in_scope(switching: DataFrame, skus: DataFrame, p: Params, brand: DataFrame | None = None) -> DataFrame:
    """The same table from a click-log result: items seen with themselves, and their names."""
    items = switching.where(F.col("src_item_id") == F.col("dst_item_id")).select("scope_id", F.col("src_item_id").alias("item_id"))
    if p.item_type == "sku":
        names = skus.select("item_sku_id", F.col("item_sku_id").alias("item_id"), F.col("sku_name").alias("item_name"))
    else:
        names = brand.where(F.col("item_id").isNotNull()).select("item_sku_id", "item_id", "item_name")
    return items.join(names, "item_id").select(
        "scope_id", "item_sku_id", "item_id", "item_name", F.lit(p.item_type).alias("item_type")).distinct()


# -- item eligibility ---------------------------------------------------------


def item_min_sales(daily: DataFrame, min_sales: float) -> DataFrame:
    """Items that sold strictly more than ``min_sales``. ``daily`` is mapped :func:`sku_daily`."""
    return (daily.groupBy("scope_id", "item_id").agg(F.sum("amount").alias("_amount"))
            .select("scope_id", "item_id", C.units("_amount").alias("sale_amount")).where(F.col("sale_amount") > min_sales))


def weekly_sales(daily: DataFrame, p: Params) -> DataFrame:
    """Sales per item and week, and whether a day of that week had positive net sales."""
    by_day = daily.groupBy("scope_id", "item_id", "sale_ord_dt").agg(F.sum("amount").alias("_day"))
    return by_week(by_day, F.lit(p.start_date))


def by_week(by_day: DataFrame, start: Column, *more: str) -> DataFrame:
    return by_day.groupBy("scope_id", "item_id", *more, C.week_number("sale_ord_dt", start).alias("week")).agg(
        F.sum("_day").alias("_amount"), F.max(F.col("_day") > 0).alias("_active"))


def active_weeks(daily: DataFrame, p: Params) -> DataFrame:
    """Items with positive sales in at least ``min_weeks`` distinct weeks."""
    return (weekly_sales(daily, p).where("_active").groupBy("scope_id", "item_id")
            .agg(F.count(F.lit(1)).alias("weeknum")).where(F.col("weeknum") >= p.min_weeks))


def eligible_items(daily: DataFrame, p: Params) -> DataFrame:
    """Both thresholds in one pass."""
    return _passed(weekly_sales(daily, p), p)


def eligible_skus(daily: DataFrame, kept: DataFrame, p: Params) -> DataFrame:
    """``eligible_items`` where every item is its sku: all skus are judged by weeks, since daily sales have a row for each day already, and those
    of the tail are left out of what has passed. Daily sales move by sku once and need no order."""
    days = daily.repartition("scope_id", "item_sku_id").select("scope_id", F.col("item_sku_id").alias("item_id"), "sale_ord_dt", F.col("amount").alias("_day"))
    return _passed(by_week(days, F.lit(p.start_date)), p).join(kept.select("scope_id", "item_id"), ["scope_id", "item_id"], "left_semi")


def _passed(weekly: DataFrame, p: Params) -> DataFrame:
    judged = weekly.groupBy("scope_id", "item_id").agg(
        F.sum("_amount").alias("_amount"), F.count_if("_active").alias("_weeks"))
    # An item without any active week fails whatever the week threshold.
    ok = (C.units("_amount") > p.min_sales) & (F.col("_weeks") >= max(p.min_weeks, 1))
    return judged.where(ok).select("scope_id", "item_id")


# -- competitor prices --------------------------------------------------------


def competitor_price(listed: DataFrame, prices: DataFrame) -> DataFrame:
    """Monthly mean price of the competitor's listed skus (site 2, status 1)."""
    wanted = listed.where(F.col("web_id").cast("string") == str(C.FOREIGN_SITE)).select(F.col("sku_id").alias("sku"))
    known = prices.where(F.col("status") == 1).select(F.col("item_sku_id").alias("sku"), F.col("avg_price").alias("mean_price"))
    return known.join(wanted, "sku").select("sku", "mean_price")
