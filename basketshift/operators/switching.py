"""Substitution from orders: spend that moves between items of consecutive baskets.

src is the item of the earlier basket, dst the item of the later one. Amounts are whole
ten-thousandths until the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import pairs
from basketshift.operators.baskets import USER

BASKET = [*USER, "seqnum"]


# -- items and scope counts ---------------------------------------------------


def items_in_scope(baskets: DataFrame, eligible: DataFrame) -> DataFrame:
    """Eligible items that appear in a basket which follows another.

    All amounts are positive here, so such an item has positive switched spend. Adds the
    number of baskets that hold the item.
    """
    seen = baskets.groupBy("scope_id", "item_id").agg(
        F.count(F.lit(1)).alias("item_ord_count"), F.max("seqnum").alias("_last"))
    return seen.where(F.col("_last") > 1).drop("_last").join(eligible, ["scope_id", "item_id"], "left_semi")


def order_count(rows: DataFrame) -> DataFrame:
    """Distinct parent orders per scope."""
    return rows.groupBy("scope_id").agg(F.countDistinct("parent_sale_ord_id").alias("n_orders"))


def scoped_rows(baskets: DataFrame, items: DataFrame) -> DataFrame:
    """Basket rows of the items in scope, with the item's basket count.

    Done before pairing: totals and counts are columns by now, so nothing that is dropped
    here is needed later.
    """
    return baskets.drop("parent_sale_ord_id", "qty").join(items, ["scope_id", "item_id"])


# -- complementarity of customers ---------------------------------------------


def theil_index(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Concentration of a customer's spend over the items in scope, and its complement index.

    Items the customer never bought count in the mean. Null where a scope has one item.
    """
    nb = items.groupBy("scope_id").agg(F.count(F.lit(1)).alias("nb"))
    sales = rows.groupBy(*USER, "item_id").agg(F.sum("amount").alias("sales"))
    s = F.col("sales").cast("double")
    sums = sales.groupBy(*USER).agg(F.sum("sales").alias("total"), F.sum(s * F.ln(s)).alias("slogs"))
    # sum((s/m) ln(s/m)) / (nb ln nb) with m = total/nb, multiplied out.
    total, n = F.col("total").cast("double"), F.col("nb").cast("double")
    t = 1 + F.try_divide(F.col("slogs") / total - F.ln(total), F.ln(n))
    return sums.join(nb, "scope_id").select(*USER, t.alias("t"), C.complement_index(t).alias("comp_index"))


# -- pairs --------------------------------------------------------------------


def _side(rows: DataFrame, prefix: str, *more: str) -> list:
    return [F.col("item_id").alias(prefix), F.col("amount").cast("double").alias(f"{prefix}_amount"),
            F.col("basket_amount").cast("double").alias(f"{prefix}_total"), F.col("item_ord_count").alias(f"{prefix}_baskets"),
            F.col("item_count").alias(f"_{prefix}_count"), *more]


def adjacent_pairs(rows: DataFrame, size: int) -> DataFrame:
    """Each item of a basket with each item of the same customer's basket before, itself included."""
    later = rows.where("prev_count is not null").select(*BASKET, *_side(rows, "dst"), "prev_count")
    earlier = (rows.where("next_count is not null").withColumn("seqnum", F.col("seqnum") + 1)
               .select(*BASKET, *_side(rows, "src"), "next_count"))
    joined = pairs.block_join(later, earlier, BASKET, left_item="dst", right_item="src", size=size,
                              left_count=("_dst_count", "prev_count"), right_count=("_src_count", "next_count"))
    spend = C.switched_spend(F.col("dst_amount"), F.col("dst_total"), F.col("src_amount"), F.col("src_total"))
    return joined.select(*BASKET, "src", "dst", "src_amount", "dst_amount", "src_baskets", "dst_baskets",
                         spend.alias("spendswitch"))


def within_pairs(rows: DataFrame, size: int, comp: DataFrame | None = None) -> DataFrame:
    """Each two different items of one basket, both ways round."""
    several = rows.where("item_count > 1")
    left = several.select(*BASKET, *_side(rows, "dst"))
    right = several.select(*BASKET, *_side(rows, "src"))
    if comp is None:
        right = right.withColumn("comp_index", F.lit(None).cast("double"))
    else:
        right = right.join(comp.select(*USER, "comp_index"), USER)
    joined = pairs.block_join(left, right, BASKET, left_item="dst", right_item="src", size=size,
                              left_count=("_dst_count", "_dst_count"), right_count=("_src_count", "_src_count"))
    spend = C.within_spend(F.col("dst_amount"), F.col("src_amount"), F.col("dst_total"))
    return joined.where(F.col("dst") != F.col("src")).select(
        *BASKET, "src", "dst", "src_amount", "dst_amount", "src_baskets", "dst_baskets", spend.alias("spendswitch"),
        "comp_index")


def within_spendswitch(within: DataFrame) -> DataFrame:
    """Within-basket spend per customer and ordered pair."""
    return within.groupBy(*USER, "src", "dst").agg(
        F.sum("dst_amount").alias("dst_amount"), F.sum("src_amount").alias("src_amount"),
        F.sum("spendswitch").alias("spendswitch"))


def adjacent_measures(adjacent: DataFrame) -> DataFrame:
    """Spend and both amounts per ordered pair, where nothing else is asked for."""
    return adjacent.groupBy("scope_id", "src", "dst").agg(*[F.sum(c).alias(c) for c in ("dst_amount", "src_amount", "spendswitch")])


def pair_measures(rows: DataFrame, size: int, comp: DataFrame | None = None) -> DataFrame:
    """Everything known of an ordered pair, from one join that makes adjacent and within-basket pairs.

    Within-basket pairs are made and added up in one order only, and mirrored when they are few. ``comp`` has the customers' complement
    index. ``n_adjacent`` is zero for pairs that only share baskets.
    """
    told = rows.withColumn("comp_index", F.lit(None).cast("double")) if comp is None else rows.join(comp.select(*USER, "comp_index"), USER, "left")
    met = pairs.neighbour_join(told, USER, "seqnum", item="item_id", values=["amount", "basket_amount", "item_ord_count", "comp_index"], size=size)
    near, index = F.col("_adjacent"), F.col("comp_index_a")
    a, b = F.col("amount_a").cast("double"), F.col("amount_b").cast("double")
    a_total, b_total = F.col("basket_amount_a").cast("double"), F.col("basket_amount_b").cast("double")
    spend = F.when(near, C.switched_spend(a, a_total, b, b_total)).otherwise(C.within_spend(a, b, a_total))
    once = met.groupBy("scope_id", "_adjacent", F.col("item_id_b").alias("src"), F.col("item_id_a").alias("dst")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(a).alias("dst_amount"), F.sum(b).alias("src_amount"), F.sum(spend).alias("spend"),
        F.sum(F.when(~near, spend * index)).alias("_comp"), F.sum(F.when(~near & index.isNotNull(), a + b)).alias("_shared"),
        F.max("item_ord_count_b").alias("src_baskets"), F.max("item_ord_count_a").alias("dst_baskets"))
    both = F.array(F.struct("src", "dst", "src_baskets", "dst_baskets"), F.when(~near, F.struct(
        F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("dst_baskets").alias("src_baskets"), F.col("src_baskets").alias("dst_baskets"))))
    sums = ["scope_id", "_adjacent", "n", "dst_amount", "src_amount", "spend", "_comp", "_shared"]
    # By source, as its shares are summed next: a source has at most three rows for each other item here, so pairs move once for both.
    flat = once.select(*sums, F.explode(F.array_compact(both)).alias("p")).select(*sums, "p.*").repartition("scope_id", "src")
    return flat.groupBy("scope_id", "src", "dst").agg(
        F.coalesce(F.sum(F.when(near, F.col("n"))), F.lit(0)).alias("n_adjacent"),
        F.sum(F.when(near, F.col("dst_amount"))).alias("dst_amount"), F.sum(F.when(near, F.col("src_amount"))).alias("src_amount"),
        F.sum(F.when(near, F.col("spend"))).alias("spendswitch"), F.coalesce(F.sum(F.when(~near, F.col("n"))), F.lit(0)).alias("ab_count"),
        F.sum("_comp").alias("_comp"), F.sum("_shared").alias("_shared"),
        F.max("src_baskets").alias("src_baskets"), F.max("dst_baskets").alias("dst_baskets"))


def adjust(measures: DataFrame, orders: DataFrame, entropy: bool | Column = True) -> DataFrame:
    """Both adjustments. A pair that shares no basket keeps its spend. ``entropy`` may be a column of ``orders``.

    ``cr`` raises the spend of pairs bought together by customers who spread their spend,
    ``ci`` lowers that of pairs bought together more often than chance.
    """
    wanted = F.lit(entropy) if isinstance(entropy, bool) else entropy
    cr = F.when(wanted, F.coalesce(F.try_divide("_comp", "_shared"), F.lit(0.0))).otherwise(F.lit(0.0))
    lift = F.col("ab_count") / F.col("src_baskets") / F.col("dst_baskets") * F.col("n_orders")
    return (measures.where("n_adjacent > 0").join(orders, "scope_id")
            .withColumns({"cr": cr, "ci": F.when(F.col("ab_count") > 0, C.lift_index(lift)).otherwise(0.0)})
            .withColumn("spendswitch_ca", F.col("spendswitch") * (1 + F.col("cr")))
            .withColumn("spendswitch_ad", F.col("spendswitch_ca") * (1 + F.col("ci"))))


def shares(df: DataFrame, measure: str, source: str = "src") -> DataFrame:
    """Adds each row's share of its source's total. A source has at most one row per item."""
    total = F.sum(measure).over(Window.partitionBy("scope_id", source))
    return df.withColumn("_sum", total).withColumn("switch_prob", F.try_divide(measure, "_sum"))


def spendswitch_detail(adjusted: DataFrame) -> DataFrame:
    """The published detail table."""
    df = shares(adjusted, "spendswitch_ad")
    return df.select(
        F.col("dst").alias("item_id"), F.col("src").alias("from_item_id"),
        C.units("dst_amount").alias("before_prefr_amount"), C.units("src_amount").alias("from_before_prefr_amount"),
        C.units("spendswitch").alias("spendswitch"), "cr", C.units("spendswitch_ca").alias("spendswitch_ca"), "ci",
        C.units("spendswitch_ad").alias("spendswitch_ad"), C.units("_sum").alias("spendswitch_sum"), "switch_prob",
        "scope_id", F.lit("order").alias("model"))


def switching(detail: DataFrame) -> DataFrame:
    """The published switching table."""
    return detail.select("scope_id", F.col("from_item_id").alias("src_item_id"), F.col("item_id").alias("dst_item_id"),
                         F.col("switch_prob").alias("switching_prob"), "model")
