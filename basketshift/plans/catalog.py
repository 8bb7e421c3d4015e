"""The named queries over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import attributes as A
from basketshift.operators import baskets as B
from basketshift.operators import facts as X
from basketshift.operators import importance as M
from basketshift.operators import publish as K
from basketshift.operators import quality as Q
from basketshift.operators import scope as S
from basketshift.operators import switching as W
from basketshift.params import Params
from basketshift.plans.cdt_path import CdtInputs, CdtPath
from basketshift.plans.log_path import LogInputs, LogPath
from basketshift.plans.mixed_path import MixedOrderPath
from basketshift.plans.monthly import MonthlyState
from basketshift.plans.order_path import OrderInputs, OrderPath
from basketshift.session import stage, staging_path
from basketshift.sources import readers as R
from basketshift.sources import schemas
from basketshift.sources.load import load_tsv
from basketshift.sources.star import Star

Query = Callable[[SparkSession, str], DataFrame]

START, END = date(1995, 8, 1), date(2001, 7, 31)
YEARS = 6
LOG_END = date(2024, 1, 31)
LOG_CODES = ("view", "click", "purchase", "signup")
CLASSIFY = "noun"

_queries: dict[str, Query] = {}


def query(fn: Callable) -> Callable:
    _queries[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def r(name: str, places: int = 6, alias: str | None = None):
    return F.round(F.col(name).cast("double"), places).alias(alias or name)


def big(name: str, alias: str | None = None):
    return F.col(name).cast("bigint").alias(alias or name)


# -- bindings -----------------------------------------------------------------


def params(item_type: str = "sku", by_day: bool = False, entropy: bool = True) -> Params:
    return Params(end_date=END, start_date=START, prod_tail=0.95, min_sales=500_000, min_weeks=10, min_baskets=2,
                  max_baskets=24, non_promo_only=True, basket_by_day=by_day, adjust_for_entropy=entropy, item_type=item_type)


def scopes(star: Star, self_pop: str = "self", item_type: str = "sku") -> DataFrame:
    tree = star.category_tree()
    return S.scope_table(S.category_enrich(tree, tree), self_pop, item_type)


def sub_scopes(star: Star) -> DataFrame:
    return S.lvl4_scopes(scopes(star), star.sku_master(), star.attributes(), CLASSIFY)


def order_path(spark: SparkSession, folder: str, item_type: str = "sku", by_day: bool = False, entropy: bool = True) -> OrderPath:
    star = Star(spark, folder)
    inputs = OrderInputs(star.order_lines(), R.sku_scan(star.sku_master()), scopes(star, item_type=item_type))
    if item_type == "brand":
        inputs.attributes, inputs.brands = star.attributes(), star.brand_dict()
    return OrderPath(inputs, params(item_type, by_day, entropy))


def log_path(spark: SparkSession, folder: str, item_type: str = "sku") -> LogPath:
    """One scope that joins all categories: clicks per category are few."""
    star = Star(spark, folder)
    tree = star.category_tree()
    whole = tree.agg(F.concat_ws("-", F.array_sort(F.collect_set("item_third_cate_cd"))).alias("item_third_cate_cd"))
    joined = S.scope_table(S.category_enrich(whole, tree), "self", item_type)
    p = Params(end_date=LOG_END, start_date=date(2024, 1, 20), item_type=item_type)
    return LogPath(LogInputs(star.click_log(), R.sku_scan(star.sku_master()), joined, star.attributes(), star.brand_dict()), p, LOG_CODES)


def derived_attributes(star: Star) -> DataFrame:
    """The attributes plus price, volume and unit keys, some of which have displayed twins."""
    part = star.table("part")
    number, kind = F.col("p_partkey"), F.col("p_type")

    def row(name, value):
        return F.struct(F.lit(1).alias("web_id"), F.lit(name).alias("attr_name"), value.cast("string").alias("attr_value"))

    price, size = F.col("p_retailprice").cast("decimal(18,2)"), F.col("p_size")
    rows = F.array_compact(F.array(
        row("price", price), F.when(kind.isin("ECONOMY", "LARGE"), row("价格", price)),
        row("volume", size), F.when(kind == "PROMO", row("总容量", size)), F.when(kind == "SMALL", row("总重量", size)),
        F.when(number % 2 == 0, row("unit", number % 7))))
    more = part.select(number.cast("string").alias("sku_id"), F.explode(rows).alias("x")).select("sku_id", "x.*")
    return star.attributes().unionByName(more)


def cdt_path(spark: SparkSession, folder: str, derived: bool = False, o: OrderPath | None = None) -> CdtPath:
    star = Star(spark, folder)
    o = o or order_path(spark, folder)
    attrs = derived_attributes(star) if derived else star.attributes()
    # The facts are the lines of the same window, once per scope that holds their sku.
    return CdtPath(CdtInputs(o.switching, A.scoped_attributes(attrs, o.member), o.facts))


def scoped_attrs(spark: SparkSession, folder: str, derived: bool = False) -> DataFrame:
    """Attributes per scope, without the facts."""
    star = Star(spark, folder)
    member = S.membership(scopes(star), R.sku_scan(star.sku_master()))
    return A.scoped_attributes(derived_attributes(star) if derived else star.attributes(), member)


def control_table(star: Star) -> DataFrame:
    """Load-done flags: one per order quarter and priority."""
    return (star.table("orders").groupBy(F.trunc("o_orderdate", "quarter").cast("string").alias("dt"), F.col("o_orderpriority").alias("cid3"))
            .agg(F.min("o_orderkey").alias("k")).select(F.when(F.col("k") % 3 == 0, "0").otherwise("1").alias("status"), "dt", "cid3"))


# -- scans --------------------------------------------------------------------


@query
def order_scan(spark, folder):
    df = R.order_scan(Star(spark, folder).order_lines(with_category=True), START, END, ["ECONOMY", "PROMO"])
    return df.select("user_id", "parent_sale_ord_id", "item_sku_id", "sale_ord_id", "sale_ord_dt", "sale_qtty",
                     r("after_prefr_amount", 4), r("before_prefr_amount", 2))


@query
def sku_type(spark, folder):
    return R.sku_scan(Star(spark, folder).sku_master()).select("item_sku_id", "sku_name", "cid3", "sku_type")


@query
def partition_scan(spark, folder):
    """All date rules of the dated extracts, over orders by day."""
    table = Star(spark, folder).table("orders").withColumn("dt", F.to_date("o_orderdate"))
    keys, day = ["1-URGENT", "5-LOW"], date(1998, 3, 15)
    cols = ["o_orderkey", "dt"]
    common = dict(key_col="o_orderpriority", keys=keys, columns=cols)
    done = F.col("o_orderstatus") == "F"
    found = {
        "assortment": R.partition_scan(table, dt_op="<=", dt=day, **common),
        "match": R.partition_scan(table, dt_op="=", dt=day, **common),
        "brand_mapping": R.partition_scan(table, dt_op="=", dt=day, extra=done, **common),
        "profit_loss": R.partition_scan(table, dt_op="range", dt_from=date(1998, 1, 1), dt=day, **common),
        "past_assortment": R.partition_scan(table, dt_op="<", dt=day, **common),
        "forecast": R.partition_scan(table, **common),
        "brand_dict": R.partition_scan(table, dt_op="=", dt=day, columns=cols),
        "category_role": R.partition_scan(table, columns=cols),
    }
    parts = [df.withColumn("variant", F.lit(k)) for k, df in found.items()]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


@query
def ext_attr_scan(spark, folder):
    part = Star(spark, folder).table("part")
    attrs = part.select(
        (F.col("p_size") % 4).alias("data_type"), F.col("p_partkey").cast("string").alias("item_sku_id"),
        F.lit("colour").alias("com_attr_name"), F.split("p_name", " ")[0].alias("com_attr_value_name"),
        F.col("p_type").alias("cate_id"), F.when(F.col("p_partkey") % 3 == 0, "2001-07-30").otherwise("2001-07-31").alias("dt"))
    return R.ext_attr_scan(attrs, "2001-07-31", ["SMALL", "LARGE", "MEDIUM"])


@query
def view_scan(spark, folder):
    return R.view_scan(Star(spark, folder).click_log(), LOG_END, LOG_CODES)


@query
def tsv_null_rows(spark, folder):
    """The sku table as tab-separated text with null tokens, read back."""
    k = F.col("p_partkey")
    token = (F.when(k % 11 == 0, "NULL").when(k % 11 == 1, "None").when(k % 11 == 2, "nan").when(k % 11 == 3, "N/A")
             .when(k % 11 == 4, "").otherwise(F.col("p_name")))
    blank = k % 13 == 0
    text = Star(spark, folder).table("part").select(
        F.when(~blank, k.cast("string")).alias("item_sku_id"), F.when(~blank, token).alias("sku_name"),
        F.when(~blank, F.when(k % 5 == 0, "NA").otherwise(F.col("p_size").cast("string"))).alias("size"),
        F.when(~blank, F.concat(F.lit('"'), "p_brand")).alias("brand"))
    path = staging_path(spark, "tsv")
    R.write_tsv(text, path, header=True)
    return R.read_tsv(spark, path, "item_sku_id string, sku_name string, size int, brand string")


@query
def tsv_rejects(spark, folder):
    """The sku table as text in which some lines have a bad number, no key, a column too many or too few, or no value at all."""
    k, tab = F.col("p_partkey"), "\t"
    size = F.when(k % 7 == 0, "big").when(k % 7 == 1, "NULL").otherwise(F.col("p_size").cast("string"))
    whole = F.concat_ws(tab, F.when(k % 17 == 0, "NA").otherwise(k.cast("string")), F.regexp_replace("p_name", "a", "N/A"), size, F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
    line = (F.when(k % 13 == 0, F.concat(whole, F.lit("\tmore"))).when(k % 13 == 1, F.concat_ws(tab, k.cast("string"), "p_name"))
            .when(k % 13 == 2, "NULL\t\tnan\tN/A").otherwise(whole))
    path = staging_path(spark, "tsv")
    Star(spark, folder).table("part").select(F.concat_ws("\n", F.lit("item_sku_id\tsku_name\tsize\tprice"), line).alias("value")).write.text(path)
    found = load_tsv(spark, path, "item_sku_id string, sku_name string, size int, price decimal(18,2)", "part", ["item_sku_id"])
    none = F.lit(None).cast("string")
    rows = found.rows.select(F.lit("row").alias("kind"), "item_sku_id", "sku_name", big("size"), r("price", 2), none.alias("line"), none.alias("reason"))
    return rows.unionByName(found.rejects.select(F.lit("reject").alias("kind"), *[none.cast(t).alias(c) for c, t in rows.dtypes[1:5]], "line", "reason"))


@query
def pending_scopes(spark, folder):
    return R.pending_scopes(control_table(Star(spark, folder)))


# -- time and scopes ----------------------------------------------------------


@query
def time_frame(spark, folder):
    """The analysis window of every day on which somebody ordered."""
    days = Star(spark, folder).table("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    end = C.last_day_of_previous_month("day")
    return days.select("day", end.alias("default_end"), C.window_start(end, YEARS).alias("default_start"),
                       C.window_start("day", YEARS).alias("start_date"), C.publish_date("day").alias("publish_date"),
                       C.week_number("day", date(1995, 1, 1)).cast("bigint").alias("week"))


@query
def category_enrich(spark, folder):
    """Category lists as they occur in orders; every tenth customer adds one the tree lacks."""
    star = Star(spark, folder)
    lines = star.order_lines(with_category=True)
    lists = lines.groupBy("parent_sale_ord_id", "user_id").agg(F.array_sort(F.collect_set("cid3")).alias("c"))
    joined = F.concat_ws("-", "c")
    gift = F.when(F.col("user_id").cast("bigint") % 10 == 0, F.concat(joined, F.lit("-GIFT"))).otherwise(joined)
    return S.category_enrich(lists.select(gift.alias("item_third_cate_cd")), star.category_tree())


@query
def scope_table(spark, folder):
    star = Star(spark, folder)
    lvl3 = scopes(star).unionByName(scopes(star, "pop", "brand"))
    return S.scope_descriptor(lvl3).join(lvl3.select(F.col("scope_id").alias("id"), "super_scope_id"), "id")


@query
def lvl4_scopes(spark, folder):
    return sub_scopes(Star(spark, folder)).select("scope_id", "super_scope_id", "item_third_cate_cd", "scope_type", "scope_desc")


@query
def seller_scope(spark, folder):
    """Lines per sku for self, pop and all-seller scopes at once."""
    star = Star(spark, folder)
    three = scopes(star).unionByName(scopes(star, "pop")).unionByName(scopes(star, "all"))
    facts = X.scope_facts(star.order_lines(), S.membership(three, R.sku_scan(star.sku_master())), params())
    return facts.groupBy("scope_id", "item_sku_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def seller_scope_history(spark, folder):
    """The same lines over a sku master with two snapshot days and repeated rows."""
    star = Star(spark, folder)
    three = scopes(star).unionByName(scopes(star, "pop")).unionByName(scopes(star, "all"))
    days = F.explode(F.array(*map(F.lit, ("2001-06-30", "2001-07-31", "2001-07-31"))))
    history = R.sku_scan(star.sku_master()).drop("dt").withColumn("dt", days)
    facts = X.scope_facts(star.order_lines(), S.membership(three, history), params())
    return facts.groupBy("scope_id", "item_sku_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def lvl4_scope(spark, folder):
    star = Star(spark, folder)
    member = S.membership(sub_scopes(star), R.sku_scan(star.sku_master()), star.fourth_category())
    facts = X.scope_facts(star.order_lines(), member, params())
    return facts.groupBy("scope_id", "item_sku_id").agg(F.count(F.lit(1)).alias("n_lines"))


# -- facts --------------------------------------------------------------------


@query
def customer_orders(spark, folder):
    return order_path(spark, folder).customers.select("scope_id", "user_id", "ord_qtty")


@query
def customer_filter(spark, folder):
    o = order_path(spark, folder)
    return X.customer_filter(o.facts, o.customers, o.p).groupBy("scope_id", "user_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def nonpromo_filter(spark, folder):
    df = X.nonpromo_filter(R.order_scan(Star(spark, folder).order_lines(), START, END))
    return df.select("sale_ord_id", "item_sku_id", r("after_prefr_amount", 4), r("before_prefr_amount", 2))


@query
def prod_tail(spark, folder):
    o = order_path(spark, folder)
    return X.prod_tail(o.daily, o.p.prod_tail).select("scope_id", "item_sku_id", "sale_qtty", r("cum_ratio"))


@query
def brand_map(spark, folder):
    star = Star(spark, folder)
    return X.brand_map(star.attributes(), star.brand_dict())


@query
def competitor_price(spark, folder):
    """Unit prices of the listed competitor skus, means over their order lines."""
    star = Star(spark, folder)
    k = F.col("p_partkey")
    listed = star.table("part").select(k.cast("string").alias("sku_id"), F.when(k % 5 == 0, "2").otherwise("1").alias("web_id"))
    unit = F.sum(C.scaled("l_extendedprice")) / F.sum(C.scaled("l_quantity"))
    prices = star.table("lineitem").groupBy("l_partkey").agg(unit.alias("avg_price")).select(
        F.col("l_partkey").cast("string").alias("item_sku_id"), "avg_price",
        F.when(F.col("l_partkey") % 3 == 0, 0).otherwise(1).alias("status"))
    return X.competitor_price(listed, prices).select("sku", r("mean_price"))


@query
def sku_in_scope(spark, folder):
    return order_path(spark, folder).sku_in_scope


@query
def sku_in_scope_brand(spark, folder):
    return order_path(spark, folder, "brand").sku_in_scope


@query
def sku_in_scope_log(spark, folder):
    return log_path(spark, folder).sku_in_scope


@query
def item_min_sales(spark, folder):
    o = order_path(spark, folder)
    return X.item_min_sales(o.mapped_daily, o.p.min_sales).select("scope_id", "item_id", r("sale_amount", 2))


@query
def active_weeks(spark, folder):
    o = order_path(spark, folder)
    return X.active_weeks(o.mapped_daily, o.p)


@query
def items_in_scope(spark, folder):
    return order_path(spark, folder).items


# -- baskets ------------------------------------------------------------------


@query
def basket_seq(spark, folder):
    o = order_path(spark, folder)
    return B.number_baskets(o.purchases, False).select("scope_id", "user_id", "parent_sale_ord_id", "item_id", big("seqnum"))


@query
def basket_seq_day(spark, folder):
    o = order_path(spark, folder, by_day=True)
    return B.number_baskets(o.purchases, True).select("scope_id", "user_id", "sale_ord_dt", "item_id", big("seqnum"))


@query
def basket_items(spark, folder):
    return order_path(spark, folder, "brand").baskets.select(
        "scope_id", "user_id", big("seqnum"), "item_id", C.units("qty").alias("sale_qtty"), C.units("amount").alias("before_prefr_amount"))


@query
def basket_totals(spark, folder):
    rows = order_path(spark, folder).baskets
    return rows.select("scope_id", "user_id", big("seqnum"), C.units("basket_amount").alias("basket_amount"), "item_count").distinct()


# -- switching from orders ----------------------------------------------------


@query
def spendswitch(spark, folder):
    rows = W.adjacent_measures(order_path(spark, folder).adjacent)
    return rows.select("scope_id", "src", "dst", (F.round(C.units("src_amount"), 2)).alias("src_amount"),
                       F.round(C.units("dst_amount"), 2).alias("dst_amount"), F.round(C.units("spendswitch"), 4).alias("spendswitch"))


@query
def theil_index(spark, folder):
    return order_path(spark, folder).theil.select("scope_id", "user_id", r("t"), r("comp_index"))


@query
def within_spendswitch(spark, folder):
    df = W.within_spendswitch(order_path(spark, folder, "brand").within)
    return df.select("scope_id", "user_id", "src", "dst", F.round(C.units("src_amount"), 2).alias("src_amount"),
                     F.round(C.units("dst_amount"), 2).alias("dst_amount"), F.round(C.units("spendswitch"), 4).alias("spendswitch"))


@query
def comp_rate(spark, folder):
    df = order_path(spark, folder, "brand").measures.where("_shared is not null")
    return df.select("scope_id", "src", "dst", F.round(F.try_divide("_comp", "_shared"), 6).alias("cr"))


@query
def spendswitch_ca(spark, folder):
    df = order_path(spark, folder, "brand").adjusted
    return df.select("scope_id", "src", "dst", r("cr"), F.round(C.units("spendswitch_ca"), 4).alias("spendswitch_ca"))


@query
def lift_ci(spark, folder):
    df = order_path(spark, folder, "brand").adjusted.where("ab_count > 0")
    return df.select("scope_id", "src", "dst", "ab_count", "src_baskets", "dst_baskets", r("ci"))


@query
def spendswitch_ad(spark, folder):
    df = order_path(spark, folder).adjusted
    return df.select("scope_id", "src", "dst", r("ci"), F.round(C.units("spendswitch_ad"), 4).alias("spendswitch_ad"))


@query
def spendswitch_detail(spark, folder):
    df = order_path(spark, folder, entropy=False).detail
    return df.select(
        "item_id", "from_item_id", r("before_prefr_amount", 2), r("from_before_prefr_amount", 2), r("spendswitch", 4), r("cr"),
        r("spendswitch_ca", 4), r("ci"), r("spendswitch_ad", 4), r("spendswitch_sum", 4), r("switch_prob"), "scope_id", "model")


def _switching(df: DataFrame) -> DataFrame:
    return df.select("scope_id", "src_item_id", "dst_item_id", r("switching_prob"), "model")


@query
def switch_prob_order(spark, folder):
    return _switching(order_path(spark, folder).switching)


@query
def switch_prob_order_brand(spark, folder):
    return _switching(order_path(spark, folder, "brand").switching)


@query
def switch_prob_order_day(spark, folder):
    return _switching(order_path(spark, folder, by_day=True).switching)


def mixed_path(spark: SparkSession, folder: str) -> MixedOrderPath:
    """Sku and brand scopes of every category, whose parameters differ by category and item type."""
    star = Star(spark, folder)
    both = scopes(star).unionByName(scopes(star, item_type="brand"))
    cid3, brand = F.col("item_third_cate_cd"), F.col("item_type") == "brand"
    late = cid3.isin("ECONOMY", "LARGE", "PROMO")
    own = both.select(
        "scope_id", F.when(late, F.lit("1995-08-01")).otherwise("1995-01-01").cast("date").alias("start_date"),
        F.when(late, F.lit("2001-07-31")).otherwise("2000-12-31").cast("date").alias("end_date"),
        F.when(brand, 0.9).when(cid3 == "LARGE", 1.0).alias("prod_tail"), F.when(brand, 300_000.0).alias("min_sales"),
        F.when(cid3 == "SMALL", 6).alias("min_weeks"), F.when(late, 1).alias("min_baskets"), F.when(brand, 30).alias("max_baskets"),
        F.when(cid3 == "MEDIUM", F.lit(False)).alias("non_promo_only"), F.when(cid3 == "PROMO", "0.93").alias("promo_ratio"),
        (cid3.isin("STANDARD", "PROMO") & brand).alias("basket_by_day"), F.when(cid3 == "ECONOMY", F.lit(False)).alias("adjust_for_entropy"))
    inputs = OrderInputs(star.order_lines(), R.sku_scan(star.sku_master()), both, star.attributes(), star.brand_dict())
    return MixedOrderPath(inputs, params(), own)


@query
def switch_prob_order_mixed(spark, folder):
    """Two windows, several thresholds, skus and brands, order and day baskets in one job."""
    return _switching(mixed_path(spark, folder).switching)


@query
def sku_in_scope_mixed(spark, folder):
    return mixed_path(spark, folder).sku_in_scope


# -- switching from clicks ----------------------------------------------------


@query
def coview_counts(spark, folder):
    return log_path(spark, folder).counts


@query
def switch_prob_log(spark, folder):
    return _switching(log_path(spark, folder).switching)


@query
def switch_prob_log_brand(spark, folder):
    return _switching(log_path(spark, folder, "brand").switching)


# -- attributes ---------------------------------------------------------------


@query
def pair_base(spark, folder):
    return A.pair_base(order_path(spark, folder).switching).select(*A.PAIR, r("switching_prob"))


@query
def attr_split(spark, folder):
    cat, num = A.attr_split(scoped_attrs(spark, folder))
    parts = (cat.select("scope_id", "attr_key", "item_id", F.col("attr_val").alias("text_val"), F.lit(None).cast("double").alias("num_val")),
             num.select("scope_id", "attr_key", "item_id", F.lit(None).cast("string").alias("text_val"), F.col("attr_val").alias("num_val")))
    return parts[0].unionByName(parts[1])


@query
def attr_split_dirty(spark, folder):
    """Keys whose values are numbers in several spellings, null tokens, or text that merely looks like a number."""
    star = Star(spark, folder)
    n = F.col("p_partkey")

    def row(name, value):
        return F.struct(F.lit(1).alias("web_id"), F.lit(name).alias("attr_name"), value.alias("attr_value"))

    digits = (n % 10).cast("string")
    spellings = F.element_at(F.array(*map(F.lit, ("1e2", "+3.", " .5 ", "N/A", "-0.25"))), (n % 5 + 1).cast("int"))
    rows = F.array(row("spelled", spellings), row("not a number", F.when(n % 3 == 0, "NaN").otherwise(digits)),
                   row("infinite", F.when(n % 3 == 0, "Infinity").otherwise(digits)), row("suffixed", F.when(n % 3 == 0, "5d").otherwise(digits)),
                   row("blank", F.when(n % 3 == 0, "  ").otherwise(digits)))
    dirty = star.table("part").select(n.cast("string").alias("sku_id"), F.explode(rows).alias("x")).select("sku_id", "x.*")
    cat, num = A.attr_split(A.scoped_attributes(dirty, S.membership(scopes(star), R.sku_scan(star.sku_master()))))
    return (cat.select("scope_id", "attr_key", "item_id", F.col("attr_val").alias("text_val"), F.lit(None).cast("double").alias("num_val"))
            .unionByName(num.select("scope_id", "attr_key", "item_id", F.lit(None).cast("string").alias("text_val"), F.col("attr_val").alias("num_val"))))


@query
def attr_collapse(spark, folder):
    """The largest value per brand: the values of a brand's skus compete."""
    attrs = scoped_attrs(spark, folder)
    brands = Star(spark, folder).sku_master().select(F.col("item_sku_id").alias("item_id"), "p_brand")
    return A.attr_collapse(attrs.join(brands, "item_id").drop("item_id").withColumnRenamed("p_brand", "item_id"))


@query
def attr_filter(spark, folder):
    star = Star(spark, folder)
    subs = sub_scopes(star)
    member = S.membership(subs, R.sku_scan(star.sku_master()), star.fourth_category())
    ignored = subs.where(F.col("scope_desc").isin("bolt", "ring")).select("scope_id", F.lit("colour").alias("ignored_attr"))
    return A.attr_filter(A.scoped_attributes(star.attributes(), member), subs, CLASSIFY, ignored, exclude=["size"])


@query
def attr_dedupe(spark, folder):
    out = A.attr_dedupe(A.attr_keys(scoped_attrs(spark, folder, derived=True)))
    return out.select("scope_id", F.explode("keys").alias("attr_key"), "names").select(
        "scope_id", "attr_key", F.coalesce(F.try_element_at("names", F.col("attr_key")), F.lit("")).alias("shown_as"))


@query
def attr_categorical(spark, folder):
    return cdt_path(spark, folder).categorical.select(*A.PAIR, "attr_key", r("similarity"))


@query
def attr_numeric(spark, folder):
    return cdt_path(spark, folder, derived=True).numeric.select(*A.PAIR, "attr_key", r("similarity"))


@query
def pair_sales(spark, folder):
    return cdt_path(spark, folder).with_sales.select(*A.PAIR, r("switching_prob"), r("fromSales", 4), r("toSales", 4))


@query
def pair_sales_brand(spark, folder):
    """Sales of brands: those of the scope's own categories."""
    star = Star(spark, folder)
    o = order_path(spark, folder, "brand")
    sales = A.item_net_sales(R.order_scan(star.order_lines(), START, END), o.brand, o.scopes, star.sku_master())
    return A.pair_sales(A.pair_base(o.switching), sales).select(*A.PAIR, r("switching_prob"), r("fromSales", 4), r("toSales", 4))


@query
def attr_matrix(spark, folder):
    """All keys of all scopes, derived ones included, side by side."""
    m = cdt_path(spark, folder, derived=True).matrix()
    known = [*A.PAIR, "switchProb", "fromSales", "toSales"]
    return m.select(*A.PAIR, r("switchProb"), r("fromSales", 4), r("toSales", 4), *[r(c) for c in m.columns if c not in known])


@query
def cdt_translate(spark, folder):
    """Display names over every attribute key of every scope, before and after the twins go."""
    attrs = scoped_attrs(spark, folder, derived=True)
    keys = A.attr_keys(attrs)
    cdt = attrs.groupBy("scope_id", F.col("attr_key").alias("attdesc")).agg(F.countDistinct("item_id").alias("n_items"))
    return M.cdt_translate(cdt, A.attr_dedupe(keys))


@query
def cdt_rf(spark, folder):
    return cdt_path(spark, folder, derived=True).forest.select("scope_id", "attdesc", r("Estimate", 5), "SimulationType")


@query
def cdt_enet(spark, folder):
    return cdt_path(spark, folder, derived=True).elastic_net.select("scope_id", "attdesc", r("Estimate", 5), "SimulationType")


# -- checks -------------------------------------------------------------------


def _brand_scopes(star: Star) -> tuple[DataFrame, DataFrame]:
    """Finer categories (type and brand), so that some months have no orders, and their skus."""
    skus = R.sku_scan(star.sku_master()).withColumn("cid3", F.concat_ws(":", "cid3", "p_brand"))
    cats = skus.select(F.lit("1").alias("item_first_cate_cd"), F.lit("11").alias("item_second_cate_cd"),
                       F.col("cid3").alias("item_third_cate_cd"), F.lower("cid3").alias("scope_desc")).distinct()
    return stage(S.scope_table(cats, "self", "sku"), "scopes"), skus


def _input_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    star = Star(spark, folder)
    fine, skus = _brand_scopes(star)
    lines = star.order_lines().where("sale_ord_valid_flag = 1").join(skus.select("item_sku_id", "cid3"), "item_sku_id")
    return Q.month_coverage(lines, fine, END), fine, skus


@query
def month_coverage(spark, folder):
    return _input_parts(spark, folder)[0]


@query
def input_check(spark, folder):
    """Checked over all attributes; a scope of a category without skus joins those with missing months."""
    coverage, fine, skus = _input_parts(spark, folder)
    ghost = fine.limit(1).select(*[F.lit("GHOST").alias(c) if c in ("item_third_cate_cd", "scope_desc") else F.col(c) for c in C.SCOPE_PARTS])
    every = fine.unionByName(S.scope_table(ghost, "self", "sku"))
    return Q.input_check(coverage, skus, Star(spark, folder).attributes(), every).select("scope_id", big("input_check"))


def _sku_number(spark: SparkSession, folder: str) -> DataFrame:
    star = Star(spark, folder)
    both = stage(scopes(star).unionByName(sub_scopes(star)), "scopes")
    lines = R.order_scan(star.order_lines(), date(1999, 8, 1), END)
    return Q.sku_number(both, R.sku_scan(star.sku_master()), lines, star.fourth_category())


@query
def sku_number(spark, folder):
    return _sku_number(spark, folder)


def _tampered(switching: DataFrame) -> DataFrame:
    """A result with three kinds of errors, each in one category's scope."""
    cid3 = F.split("scope_id", "_")[2]
    p = F.col("switching_prob")
    wrong = F.when(cid3 == "ECONOMY", p + 1).when(cid3 == "LARGE", -p).when(cid3 == "MEDIUM", F.lit(0.5)).otherwise(p)
    stated = F.when((cid3 == "PROMO") & (F.col("src_item_id") > "5"), "stray").otherwise(F.col("scope_id"))
    return switching.select(F.col("scope_id").alias("found_in"), stated.alias("scope_id"), wrong.alias("switching_prob"))


@query
def switch_check(spark, folder):
    o = order_path(spark, folder)
    return Q.switch_check(_tampered(o.switching), o.scopes, "found_in").select("scope_id", big("switch_check"))


@query
def cdt_check(spark, folder):
    """The forests' importances, broken in three scopes."""
    o = order_path(spark, folder)
    c = cdt_path(spark, folder, derived=True, o=o)
    cid3, est = F.split("scope_id", "_")[2], F.round("Estimate", 5)
    colour = F.col("attdesc") == "colour"
    wrong = F.when((cid3 == "SMALL") & colour, F.lit(None)).when(cid3 == "LARGE", est / 2).when((cid3 == "PROMO") & colour, float("-inf")).otherwise(est)
    stated = F.when((cid3 == "MEDIUM") & colour, "stray").otherwise(F.col("scope_id"))
    broken = c.forest.select(F.col("scope_id").alias("found_in"), stated.alias("scope_id"), wrong.alias("Estimate"), "SimulationType")
    return Q.cdt_check(broken, o.scopes, "found_in").select("scope_id", big("cdt_check"))


def _status(spark: SparkSession, folder: str) -> DataFrame:
    """All checks over whole tables. One scope is of a category that has no skus, which fails its input check."""
    star = Star(spark, folder)
    o = order_path(spark, folder)
    tree = star.category_tree()
    ghost = S.scope_table(S.category_enrich(spark.createDataFrame([("GHOST",)], "item_third_cate_cd string"), tree), "self", "sku")
    every = stage(o.scopes.unionByName(ghost), "scopes")
    lines = star.order_lines(with_category=True).where("sale_ord_valid_flag = 1")
    skus = R.sku_scan(star.sku_master())
    inputs = Q.input_check(Q.month_coverage(lines, every, END), skus, star.attributes(), every)
    numbers = Q.sku_number(every, skus, R.order_scan(star.order_lines(), date(1999, 8, 1), END))
    o.switching = stage(o.switching, "switching")
    forest = cdt_path(spark, folder, derived=True, o=o).forest
    return Q.status_table(inputs, numbers, Q.switch_check(o.switching, every), Q.cdt_check(forest, every))


@query
def status_table(spark, folder):
    return _status(spark, folder)


@query
def publish_gate(spark, folder):
    o = order_path(spark, folder)
    result = stage(o.switching, "switching")
    checks = Q.switch_check(_tampered(result), o.scopes, "found_in")
    return _switching(Q.publish_gate(result, checks, "switch_check"))


# -- state by month -----------------------------------------------------------

# Two windows over one state: whole months, and a moved one whose first and last months are cut.
WINDOWS = {"whole": (START, END), "moved": (date(1996, 3, 15), date(2001, 5, 20))}


def monthly_state(spark: SparkSession, folder: str) -> tuple[MonthlyState, DataFrame]:
    """The state after two updates, the second one after late lines came for the last three months; and the finer scopes' table."""
    star = Star(spark, folder)
    fine, skus = _brand_scopes(star)
    lines = stage(star.order_lines().join(skus.select("item_sku_id", "cid3"), "item_sku_id")
                  .withColumn("month", F.date_format("sale_ord_dt", "yyyy-MM")), "lines")
    late = (F.col("month") >= "2001-05") & (F.pmod(F.xxhash64("parent_sale_ord_id"), F.lit(4)) == 0)
    extracts, root = staging_path(spark, "extracts"), staging_path(spark, "state")
    lines.where(~late).write.partitionBy("month").parquet(extracts)
    member = S.membership(scopes(star), R.sku_scan(star.sku_master()))
    state = MonthlyState(spark, root, extracts, lines.drop("month").schema, member)
    state.update()
    lines.where(late).write.mode("append").partitionBy("month").parquet(extracts)
    state.update()
    return state, fine


def _of_windows(make: Callable[[date, date], DataFrame]) -> DataFrame:
    parts = [make(*w).withColumn("window", F.lit(name)) for name, w in WINDOWS.items()]
    return parts[0].unionByName(parts[1])


@query
def scope_counts_monthly(spark, folder):
    """Distinct orders, skus and customers per scope, from bitmaps by month."""
    state, _ = monthly_state(spark, folder)
    return _of_windows(state.scope_counts)


@query
def customer_orders_monthly(spark, folder):
    state, _ = monthly_state(spark, folder)
    return _of_windows(state.customer_orders)


@query
def prod_tail_monthly(spark, folder):
    """The long tail of both windows, from daily sales by month."""
    state, _ = monthly_state(spark, folder)
    tail = _of_windows(lambda start, end: X.prod_tail(state.daily(start, end), params().prod_tail))
    return tail.select("window", "scope_id", "item_sku_id", "sale_qtty", r("cum_ratio"))


@query
def month_coverage_monthly(spark, folder):
    state, fine = monthly_state(spark, folder)
    return state.coverage(fine, END)


# -- sinks --------------------------------------------------------------------


@query
def publish_roundtrip(spark, folder):
    """Switching through the temporary table into the final one. A first load of other content
    for two categories must be replaced, one of a third category must stay."""
    o = order_path(spark, folder)
    result = K.with_partition(stage(o.switching, "switching"), K.publish_day(END))
    tmp, pre, final = (staging_path(spark, n) for n in ("tmp", "pre", "final"))
    old = result.withColumn("model", F.lit("old"))
    K.publish(old.where(F.col("cid3").isin("ECONOMY", "PROMO", "SMALL")), tmp, pre, final, schemas.SWITCHING)
    K.publish(result.where("cid3 <> 'SMALL'"), tmp, pre, final, schemas.SWITCHING)
    df = R.partition_scan(K.read_partitions(spark, final, schemas.SWITCHING), dt_op="=", dt=str(K.publish_day(END)))
    return df.select("scope_id", "src_item_id", "dst_item_id", r("switching_prob"), "model", "dt", "cid3")


@query
def publish_rerun(spark, folder):
    """A second run that has rows for fewer categories leaves none of the first run's in the others of its work list."""
    result = K.with_partition(stage(order_path(spark, folder).switching, "switching"), K.publish_day(END))
    tmp, pre, final = (staging_path(spark, n) for n in ("tmp", "pre", "final"))
    K.publish(result.withColumn("model", F.lit("old")), tmp, pre, final, schemas.SWITCHING)
    work = [(str(K.publish_day(END)), c) for c in ("ECONOMY", "PROMO", "SMALL")]
    K.publish(result.where("cid3 = 'PROMO'"), tmp, pre, final, schemas.SWITCHING, work)
    df = K.read_partitions(spark, final, schemas.SWITCHING)
    return df.select("scope_id", "src_item_id", "dst_item_id", r("switching_prob"), "model", "dt", "cid3")


@query
def publish_interrupted(spark, folder):
    """A run over all categories stops between writing and showing its rows; a later one completes a single category."""
    result = K.with_partition(stage(order_path(spark, folder).switching, "switching"), K.publish_day(END))
    paths = [staging_path(spark, n) for n in ("tmp", "pre", "final")]
    K.publish(result.withColumn("model", F.lit("old")), *paths, schemas.SWITCHING)
    K.prepare(result.withColumn("model", F.lit("lost")), paths)
    K.publish(result.where("cid3 = 'PROMO'"), *paths, schemas.SWITCHING)
    K.vacuum(spark, paths, keep=1)
    df = K.read_partitions(spark, paths[-1], schemas.SWITCHING)
    return df.select("scope_id", "src_item_id", "dst_item_id", r("switching_prob"), "model", "dt", "cid3")


@query
def spendswitch_sink(spark, folder):
    """The detail of all scopes, loaded by category and read back for two of them."""
    root = staging_path(spark, "out")
    K.assemble({"spendswitch": [order_path(spark, folder, entropy=False).detail]}, END, root)
    schema = ("item_id string, from_item_id string, before_prefr_amount double, from_before_prefr_amount double, spendswitch double, cr double, "
              "spendswitch_ca double, ci double, spendswitch_ad double, spendswitch_sum double, switch_prob double, scope_id string, model string")
    df = K.read_partitions(spark, f"{root}/spendswitch", schema, dt=str(END), cid3=["ECONOMY", "PROMO"])
    return df.select("item_id", "from_item_id", r("spendswitch", 4), r("spendswitch_ad", 4), r("spendswitch_sum", 4), r("switch_prob"), "scope_id",
                     "model", "dt", "cid3")


@query
def sku_in_scope_sink(spark, folder):
    """The outputs of sku and brand scopes as one table, beside the scopes' own."""
    root = staging_path(spark, "out")
    paths = [order_path(spark, folder), order_path(spark, folder, "brand")]
    K.assemble({"sku_in_scope": [p.sku_in_scope for p in paths], "scope": [S.scope_descriptor(p.scopes) for p in paths]}, END, root)
    found = K.read_partitions(spark, f"{root}/sku_in_scope", schemas.SKU_IN_SCOPE)
    known = K.read_partitions(spark, f"{root}/scope", schemas.SCOPE).select(F.col("id").alias("scope_id"), "scope_desc")
    return found.join(known, "scope_id")


@query
def cdt_sink(spark, folder):
    """Importances under their own keys and under the names they are shown by, from the two published tables."""
    c = cdt_path(spark, folder, derived=True)
    root, day = staging_path(spark, "out"), K.publish_day(END)
    raw = K.publish(K.with_partition(c.forest, day), f"{root}/raw_tmp", f"{root}/raw_pre", f"{root}/raw", schemas.CDT)
    K.assemble({"cdt_cn": [c.translated(c.forest)]}, day, root)
    shown = K.read_partitions(spark, f"{root}/cdt", schemas.CDT)
    both = raw.withColumn("kind", F.lit("key")).unionByName(shown.withColumn("kind", F.lit("name")))
    return both.select("kind", "scope_id", "attdesc", r("Estimate", 5), "SimulationType", "dt", "cid3")


@query
def status_sink(spark, folder):
    """Status rows of a first day stay when those of a second one are published."""
    status = stage(_status(spark, folder), "status")
    paths = [staging_path(spark, n) for n in ("tmp", "finish")]
    for day in ("2001-07-01", str(K.publish_day(END))):
        K.publish_status(K.with_partition(status, day), *paths, schemas.STATUS)
    return K.read_partitions(spark, paths[-1], schemas.STATUS)


@query
def mark_done(spark, folder):
    """The control table after all pending rows are marked, but for a category whose fits failed."""
    path = staging_path(spark, "control")
    K.overwrite_partitions(control_table(Star(spark, folder)), path)
    control = K.read_partitions(spark, path, "status string")
    work = stage(R.pending_scopes(control), "work")
    K.mark_done(path, work.where("cid3 <> '5-LOW'"))
    return K.read_partitions(spark, path, "status string")
