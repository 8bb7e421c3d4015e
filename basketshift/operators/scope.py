"""Scopes: the units of analysis, and which skus belong to them.

Every later operator carries ``scope_id`` in its keys, so one job computes all scopes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.functions.columns import SCOPE_PARTS
from basketshift.params import SCOPE_PARAMS, Params
from basketshift.sources import schemas

# Codes and name of a category that the tree does not know.
UNKNOWN_CODE = "0"
UNKNOWN_NAME = "None"


def category_enrich(lists: DataFrame, tree: DataFrame, codes: str = "item_third_cate_cd") -> DataFrame:
    """Parent codes and names of ``-`` joined category lists, in list order.

    Equal lists are enriched once. A code outside the tree gets code 0 and name None.
    """
    known = tree.select("item_first_cate_cd", "item_second_cate_cd", F.col("item_third_cate_cd").alias("_code"),
                        "item_third_cate_name")
    parts = lists.select(F.col(codes)).distinct().select(codes, F.posexplode(F.split(codes, "-")).alias("_pos", "_code"))
    looked_up = parts.join(known, "_code", "left").select(
        codes, F.struct(
            "_pos", F.coalesce("item_first_cate_cd", F.lit(UNKNOWN_CODE)).alias("c1"),
            F.coalesce("item_second_cate_cd", F.lit(UNKNOWN_CODE)).alias("c2"),
            F.coalesce("item_third_cate_name", F.lit(UNKNOWN_NAME)).alias("name")).alias("_part"))
    ordered = looked_up.groupBy(codes).agg(F.array_sort(F.collect_list("_part")).alias("_parts"))
    return ordered.select(
        F.concat_ws("-", F.col("_parts.c1")).alias("item_first_cate_cd"),
        F.concat_ws("-", F.col("_parts.c2")).alias("item_second_cate_cd"),
        F.col(codes).alias("item_third_cate_cd"), F.concat_ws("-", F.col("_parts.name")).alias("scope_desc"))


def scope_table(categories: DataFrame, self_pop: str | Column, item_type: str | Column, scope_type: str | Column = "lvl3") -> DataFrame:
    """One row per scope, with its own id and the id of the batch it is published under. What differs by category is given as columns."""
    df = categories.withColumns({"self_pop": F.lit(self_pop), "scope_type": F.lit(scope_type), "item_type": F.lit(item_type)})
    return df.select(C.scope_id().alias("scope_id"), C.super_scope_id().alias("super_scope_id"), *SCOPE_PARTS)


def scope_params(scopes: DataFrame, defaults: Params, own: DataFrame | None = None) -> DataFrame:
    """scope_id and every parameter of SCOPE_PARAMS for every scope.

    ``own`` holds, by scope_id, any of these columns; where it has no row, no such column or a null, the default counts. A scope's item type
    is part of its identity and comes from the scope table.
    """
    want = schemas.struct(SCOPE_PARAMS)
    given = scopes.select("scope_id", "item_type")
    named = [f.name for f in want if own is not None and f.name in own.columns and f.name != "item_type"]
    if named:
        given = given.join(own.select("scope_id", *named), "scope_id", "left")

    def value(f):
        if f.name == "item_type":
            return F.col("item_type")
        default = F.lit(getattr(defaults, f.name)).cast(f.dataType)
        return (F.coalesce(F.col(f.name).cast(f.dataType), default) if f.name in named else default).alias(f.name)

    return given.select("scope_id", *[value(f) for f in want])


def lvl4_scopes(scopes: DataFrame, skus: DataFrame, attrs: DataFrame, classify_attr: str) -> DataFrame:
    """Sub-scopes: one per value that ``classify_attr`` takes among a scope's skus."""
    base = scopes.select(*SCOPE_PARTS).withColumn("cid3", F.explode(C.category_codes("item_third_cate_cd")))
    values = (attrs.where((F.col("attr_name") == classify_attr) & F.col("attr_value").isNotNull())
              .select(F.col("sku_id").alias("item_sku_id"), "attr_value")
              .join(skus.select("item_sku_id", "cid3"), "item_sku_id")
              .select("cid3", "attr_value").distinct())
    subs = (base.join(values, "cid3").drop("cid3", "scope_desc", "scope_type")
            .withColumnRenamed("attr_value", "scope_desc").withColumn("scope_type", F.lit("lvl4")).distinct())
    return subs.select(C.scope_id().alias("scope_id"), C.super_scope_id().alias("super_scope_id"), *SCOPE_PARTS)


def seller_filter(scoped_skus: DataFrame) -> DataFrame:
    """Skus whose seller type fits the ``self_pop`` of their scope; type other never does."""
    wanted, kind = F.col("self_pop"), F.col("sku_type")
    return scoped_skus.where(
        F.when(wanted.isin("self", "pop"), kind == wanted).otherwise(kind.isin("self", "pop")))


def membership(scopes: DataFrame, skus: DataFrame, fourth: DataFrame | None = None) -> DataFrame:
    """(scope_id, item_sku_id) for lvl3 and lvl4 scopes.

    ``skus`` has item_sku_id, cid3, sku_type; ``fourth`` has sku_id, attr_value. A sku that is listed
    several times, such as once per snapshot day, is one member; it belongs if any of its rows does.
    """
    wide = scopes.withColumn("cid3", F.explode(C.category_codes("item_third_cate_cd"))).select(
        "scope_id", "cid3", "self_pop", "scope_type", "scope_desc")
    scoped = seller_filter(skus.select("item_sku_id", "cid3", "sku_type").join(wide, "cid3"))
    whole = scoped.where(F.col("scope_type") != "lvl4").select("scope_id", "item_sku_id").distinct()
    if fourth is None:
        return whole
    value = fourth.select(F.col("sku_id").alias("item_sku_id"), F.col("attr_value").alias("scope_desc"))
    part = (scoped.where(F.col("scope_type") == "lvl4")
            .join(value, ["item_sku_id", "scope_desc"], "left_semi").select("scope_id", "item_sku_id").distinct())
    return whole.unionByName(part)


def scope_descriptor(scopes: DataFrame) -> DataFrame:
    """The published one-row-per-scope table."""
    return scopes.select(F.col("scope_id").alias("id"), *SCOPE_PARTS)
