"""Pairwise attribute similarity of items that switch to one another.

An item's attributes are gathered into one row with two maps, so the pair table is
joined with two narrow tables and never multiplied by the number of attributes in a
shuffle. A map has at most one entry per attribute key of the scope.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.session import stage

PAIR = ["scope_id", "src_item_id", "dst_item_id"]

# Fixed value: what an absent categorical attribute reads as.
ABSENT = "None"

# Derived attributes and the displayed attributes that say the same.
TWINS = {
    "unit": ["包装件数"],
    "volume": ["总容量", "总重量"],
    "unit_volume": ["单件容量"],
    "unit_price": ["单件价格"],
    "per_price": ["单位容量价格"],
    "price": ["价格"],
}

# Display names of derived attributes.
DISPLAY_NAMES = {
    "price": "价格",
    "unit": "包装件数",
    "volume": "总容量/总重量",
    "unit_volume": "单件容量/单件重量",
    "unit_price": "单件价格",
    "per_price": "单位容量价格/单位重量价格",
}


# -- cleaning -----------------------------------------------------------------


def scoped_attributes(attrs: DataFrame, member: DataFrame) -> DataFrame:
    """Own-site attributes of each scope's skus, trimmed: (scope_id, attr_key, item_id, attr_val)."""
    own = attrs.where(F.col("web_id") < C.FOREIGN_SITE)
    return own.join(member.withColumnRenamed("item_sku_id", "sku_id"), "sku_id").select(
        "scope_id", F.col("attr_name").alias("attr_key"), F.col("sku_id").alias("item_id"),
        C.null_tokens(F.trim("attr_value")).alias("attr_val"))


def attr_split(attrs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categorical and numeric attributes.

    A key is numeric in a scope if it has values there and each of them parses as a number. The attributes are written once, since
    the kinds and both results read them: what made them, such as the join with their scopes, is not sorted again for each.
    """
    attrs, number = stage(attrs, "attributes"), C.number("attr_val")
    kinds = attrs.groupBy("scope_id", "attr_key").agg(
        (F.count("attr_val") > 0).alias("_any"), (F.count("attr_val") == F.count(number)).alias("_all"))
    kinds = stage(kinds.select("scope_id", "attr_key", (F.col("_any") & F.col("_all")).alias("_numeric")), "kinds")
    known = attrs.join(kinds, ["scope_id", "attr_key"])
    categorical = known.where(~F.col("_numeric")).drop("_numeric")
    numeric = known.where("_numeric").withColumn("attr_val", number).drop("_numeric")
    return categorical, numeric


def attr_collapse(attrs: DataFrame) -> DataFrame:
    """The largest value per scope, key and item."""
    return attrs.groupBy("scope_id", "attr_key", "item_id").agg(F.max("attr_val").alias("attr_val"))


def attr_filter(attrs: DataFrame, scopes: DataFrame | None = None, classify_attr: str | None = None,
                ignored: DataFrame | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Drops the attribute that defines a lvl4 scope, the scope's ignored ones, and exclusions."""
    if scopes is not None and classify_attr is not None:
        lvl4 = scopes.where(F.col("scope_type") == "lvl4").select("scope_id", F.lit(classify_attr).alias("attr_key"))
        attrs = attrs.join(lvl4, ["scope_id", "attr_key"], "left_anti")
    if ignored is not None:
        attrs = attrs.join(ignored.select("scope_id", F.col("ignored_attr").alias("attr_key")), ["scope_id", "attr_key"], "left_anti")
    return attrs.where(~F.col("attr_key").isin(*exclude)) if exclude else attrs


def attr_dedupe(keys: DataFrame) -> DataFrame:
    """Per scope, the attribute keys to keep and the display names of kept derived keys.

    ``keys`` has scope_id and an array ``keys``. A derived attribute whose twin is present
    replaces the twin and takes its name; without a twin the derived attribute goes.
    (The known behaviour walks one-element names letter by letter and so never finds those
    twins; this is the rule it means to apply.)
    """
    all_keys = F.col("keys")
    drop, names = [], []
    for derived, twins in TWINS.items():
        present = F.array_intersect(F.array(*map(F.lit, twins)), all_keys)
        has, twinned = F.array_contains(all_keys, derived), F.size(present) > 0
        drop.append(F.when(has, F.when(twinned, present).otherwise(F.array(F.lit(derived)))).otherwise(F.array().cast("array<string>")))
        names.append(F.when(has & twinned, F.struct(F.lit(derived).alias("key"), F.element_at(present, -1).alias("value"))))
    return keys.select(
        "scope_id", F.array_except(all_keys, F.flatten(F.array(*drop))).alias("keys"),
        F.map_from_entries(F.array_compact(F.array(*names))).alias("names"))


def keep_keys(attrs: DataFrame, kept: DataFrame) -> DataFrame:
    """Attribute rows whose key survived :func:`attr_dedupe`."""
    listed = kept.select("scope_id", "keys")
    return attrs.join(listed, "scope_id").where(F.array_contains("keys", F.col("attr_key"))).drop("keys")


def attr_keys(attrs: DataFrame) -> DataFrame:
    """The attribute keys of each scope as a sorted array."""
    return attrs.groupBy("scope_id").agg(F.array_sort(F.collect_set("attr_key")).alias("keys"))


# -- pairs --------------------------------------------------------------------


def pair_base(switching: DataFrame) -> DataFrame:
    """Pairs of two different items with a positive probability. Shares are not rescaled."""
    return switching.where((F.col("switching_prob") > 0) & (F.col("src_item_id") != F.col("dst_item_id"))).select(
        *PAIR, "switching_prob")


def _collapsed(categorical: DataFrame | None, numeric: DataFrame | None) -> DataFrame:
    """Both kinds in one table: (scope_id, attr_key, item_id, numeric, text, number)."""
    sides = []
    for attrs, is_number in ((categorical, False), (numeric, True)):
        if attrs is not None:
            value, none = F.col("attr_val"), F.lit(None)
            sides.append(attr_collapse(attrs).select(
                "scope_id", "attr_key", "item_id", F.lit(is_number).alias("numeric"),
                (none if is_number else value).cast("string").alias("text"), (value if is_number else none).cast("double").alias("number")))
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def _keys(categorical: DataFrame | None, numeric: DataFrame | None) -> DataFrame:
    """The keys of each scope in the order of its cells: categorical ones, then numeric ones."""
    sides = [attrs.select("scope_id", "attr_key", F.lit(is_number).alias("numeric"))
             for attrs, is_number in ((categorical, False), (numeric, True)) if attrs is not None]
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return stage(both.groupBy("scope_id").agg(*[F.array_sort(F.collect_set(F.when(kind, F.col("attr_key")))).alias(name)
                                                for name, kind in (("_texts", ~F.col("numeric")), ("_numbers", F.col("numeric")))]), "keys")


def _category(attrs: Column, key: Column) -> Column:
    """Value of a key: its text, None if the item lacks the key, null if it is there without a value."""
    has = F.coalesce(F.map_contains_key(attrs, key), F.lit(False))
    return F.when(has, F.try_element_at(attrs, key)["text"]).otherwise(F.lit(ABSENT))


def _profiles(attrs: DataFrame, keys: DataFrame) -> DataFrame:
    """Each item's values in the order of its scope's keys, so that pairs carry no names and look none up."""
    entry = F.struct("attr_key", F.struct("text", "number"))
    items = attrs.groupBy("scope_id", "item_id").agg(F.map_from_entries(F.collect_list(entry)).alias("attrs"))
    return items.join(keys, "scope_id").select(
        "scope_id", "item_id", F.transform("_texts", lambda k: _category(F.col("attrs"), k)).alias("texts"),
        F.transform("_numbers", lambda k: F.try_element_at("attrs", k)["number"]).alias("numbers"))


def _with_ends(pairs: DataFrame, sales: DataFrame | None = None, profiles: DataFrame | None = None) -> DataFrame:
    """Pairs with the sales and the profiles of both ends, null where an end has none. Pairs move once for each end."""
    for name, net in (("src", "fromSales"), ("dst", "toSales")):
        item = F.col("item_id").alias(f"{name}_item_id")
        if sales is not None:
            keys = ["scope_id"] if "scope_id" in sales.columns else []
            pairs = pairs.join(sales.select(*keys, item, F.col("sales").alias(net)), [*keys, f"{name}_item_id"], "left")
        if profiles is not None:
            pairs = pairs.join(profiles.select("scope_id", item, F.col("texts").alias(f"_{name}_texts"), F.col("numbers").alias(f"_{name}_numbers")),
                               ["scope_id", f"{name}_item_id"], "left")
    return pairs


def _fill_sales(pairs: DataFrame) -> DataFrame:
    """Missing sales become the mean over the scope's pairs, which are read twice."""
    means = stage(pairs.groupBy("scope_id").agg(F.avg("fromSales").alias("_from"), F.avg("toSales").alias("_to")), "means")
    return pairs.join(means, "scope_id").withColumns(
        {"fromSales": F.coalesce("fromSales", "_from"), "toSales": F.coalesce("toSales", "_to")}).drop("_from", "_to")


def similarity_maps(pairs: DataFrame, categorical: DataFrame | None = None, numeric: DataFrame | None = None,
                    sales: DataFrame | None = None) -> DataFrame:
    """``pairs`` with ``sims``: attribute key → similarity, for every key of the pair's scope; with ``sales``, those of :func:`pair_sales` too.

    Categorical: 1 where both items have the same value, else 0; two items without the
    attribute match. A pair with an explicit null gets the mean of its column, in which
    such pairs count 0.

    Numeric: 1 - d/max d on a log scale. A pair with a missing or invalid value gets the
    mean. Where all distances are 0 all similarities are 1; where all are missing they stay
    null.

    The joined pairs are written once, since the column statistics and the result both read
    them. Each scope has its own keys, so scopes never widen one another's rows. What there is
    of a scope is written too, so that Spark knows how small it is and moves no pairs to it.
    """
    keys = _keys(categorical, numeric)
    joined = _with_ends(pairs, sales, _profiles(_collapsed(categorical, numeric), keys)).join(keys, "scope_id")

    def of(end, kind, none):
        """An end without any attribute lacks every key."""
        return F.coalesce(f"_{end}_{kind}", F.transform(f"_{kind}", lambda k: none))

    absent, unknown = F.lit(ABSENT), F.lit(None).cast("double")
    same = F.zip_with(of("src", "texts", absent), of("dst", "texts", absent), lambda a, b: (a == b).cast("double"))
    apart = F.zip_with(of("src", "numbers", unknown), of("dst", "numbers", unknown), C.log_distance)
    net = [] if sales is None else ["fromSales", "toSales"]
    measured = stage(joined.select(*pairs.columns, *net, F.concat(same, apart).alias("cells")), "cells")
    by_key = measured.select("scope_id", F.posexplode("cells").alias("pos", "v")).groupBy("scope_id", "pos").agg(
        F.max("v").alias("max"), F.avg("v").alias("avg"), F.avg(F.coalesce("v", F.lit(0.0))).alias("matched"))
    stats = by_key.groupBy("scope_id").agg(F.array_sort(F.collect_list(F.struct("pos", "max", "avg", "matched"))).alias("_stats"))
    names = F.concat("_texts", "_numbers")
    scopes = stage(stats.join(keys, "scope_id").select("scope_id", "_stats", F.size("_texts").alias("_n_texts"), names.alias("_names")), "stats")

    def fill(v, s):
        def scaled(d):
            return F.when(s["max"] == 0, F.when(d.isNotNull(), 1.0)).otherwise(1 - F.try_divide(d, s["max"]))

        return F.when(s["pos"] < F.col("_n_texts"), F.coalesce(v, s["matched"])).otherwise(F.coalesce(scaled(v), scaled(s["avg"])))

    found = measured.join(scopes, "scope_id").select(*pairs.columns, *net, F.map_from_arrays("_names", F.zip_with("cells", "_stats", fill)).alias("sims"))
    return found if sales is None else _fill_sales(found)


def similarities(pairs: DataFrame, categorical: DataFrame | None = None, numeric: DataFrame | None = None) -> DataFrame:
    """The long form of :func:`similarity_maps`: (pair, attr_key, similarity)."""
    maps = similarity_maps(pairs, categorical, numeric)
    return maps.select(*PAIR, F.explode("sims").alias("attr_key", "similarity"))


def attr_categorical(pairs: DataFrame, attrs: DataFrame) -> DataFrame:
    return similarities(pairs, categorical=attrs)


def attr_numeric(pairs: DataFrame, attrs: DataFrame) -> DataFrame:
    return similarities(pairs, numeric=attrs)


def item_net_sales(lines: DataFrame, brand: DataFrame | None = None, scopes: DataFrame | None = None, skus: DataFrame | None = None) -> DataFrame:
    """Net sales per item over all lines of the extract; per mapped item where items are brands.

    Lines that carry scope_id, once per scope that holds their sku, give sales keyed by scope_id too. So do ``scopes`` with cid3 in
    the lines or, by sku, in ``skus``: then sales are those of each scope's own categories.
    """
    own = scopes is not None and (skus is not None or "cid3" in lines.columns)
    keys = ["scope_id"] if "scope_id" in lines.columns else ["cid3"] if own and skus is None else []
    sales = lines.groupBy(*keys, "item_sku_id").agg(F.sum(C.scaled("after_prefr_amount")).alias("_net"))
    if own and skus is not None:
        # Every row of a sku counts, as if it had met each line.
        sales = sales.join(skus.select("item_sku_id", "cid3"), "item_sku_id")
    if brand is None:
        sales = sales.withColumnRenamed("item_sku_id", "item_id")
    else:
        sales = sales.join(brand.where(F.col("item_id").isNotNull()).select("item_sku_id", "item_id"), "item_sku_id")
    if own:
        sales = sales.join(scopes.select("scope_id", F.explode(C.category_codes("item_third_cate_cd")).alias("cid3")), "cid3")
        keys = ["scope_id"]
    return sales.groupBy(*keys, "item_id").agg(C.units(F.sum("_net")).alias("sales"))


def pair_sales(pairs: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales of both ends, of the pair's scope where ``sales`` has scopes. Missing sales become the mean over the scope's pairs."""
    return _fill_sales(stage(_with_ends(pairs, sales), "sales")).select(*PAIR, "switching_prob", "fromSales", "toSales")


def matrix_keys(maps: DataFrame) -> list[str]:
    """The attribute keys of all scopes: the columns of their wide matrix, so the driver must know them."""
    return sorted(r["k"] for r in maps.select(F.explode(F.map_keys("sims")).alias("k")).distinct().collect())


def attr_matrix(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per pair, one column for each of ``keys``. A key foreign to a scope is null there.

    ``maps`` is :func:`similarity_maps` of pairs with their sales.
    """
    return maps.select(*PAIR, F.col("switching_prob").alias("switchProb"), *[F.try_element_at("sims", F.lit(k)).alias(k) for k in keys],
                       "fromSales", "toSales")
