"""Adapter: the roles the operators need, read from a TPC-H-like star schema.

Category is ``p_type``, the fourth level is the noun in ``p_name``, the seller code is
derived from ``p_size``. Every tenth sku lacks a size, every fifth has a foreign brand
row, one brand is missing from the dictionary and one is in it twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketshift.functions.columns import BRAND_ATTR


# Schemas of tables read before in this process, so that each is looked up once.
_schemas: dict[str, StructType] = {}


class Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def order_lines(self, with_category: bool = False) -> DataFrame:
        """Order lines. The category needs a join with the sku table, so it is optional:
        the scope membership already restricts skus to categories."""
        orders, lines = self.table("orders"), self.table("lineitem")
        before = F.col("l_extendedprice").cast("decimal(18,2)")
        after = (before * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
        order = F.col("l_orderkey").cast("string")
        # Joined as they are stored: texts and decimals made before would be moved too.
        df = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_partkey").cast("string").alias("item_sku_id"), order.alias("parent_sale_ord_id"),
            F.concat_ws("-", order, F.col("l_linenumber").cast("string")).alias("sale_ord_id"),
            F.col("l_quantity").alias("sale_qtty"), before.alias("before_prefr_amount"), after.alias("after_prefr_amount"),
            F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderdate").alias("sale_ord_tm"),
            F.to_date("o_orderdate").alias("sale_ord_dt"), F.when(F.col("o_orderstatus").isin("F", "O"), 1).otherwise(0).alias("sale_ord_valid_flag"))
        if with_category:
            df = df.join(self.sku_master().select("item_sku_id", "cid3"), "item_sku_id")
        return df

    def sku_master(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("item_sku_id"), F.col("p_name").alias("sku_name"),
            F.col("p_type").alias("cid3"), "p_brand",
            F.when(size <= 30, 10).when(size <= 45, (size - 31) % 9 + 1).otherwise(0).alias("data_type"))

    def attributes(self) -> DataFrame:
        """Long attributes, one pass over the sku table."""
        part = self.table("part").select(
            F.col("p_partkey").alias("k"), "p_brand", F.split("p_name", " ").alias("words"),
            F.col("p_size").cast("string").alias("size"))

        def row(web, name, value):
            return F.struct(F.lit(web).alias("web_id"), F.lit(name).alias("attr_name"), value.alias("attr_value"))

        rows = F.array(
            row(1, BRAND_ATTR, F.col("p_brand")), row(1, "colour", F.col("words")[0]), row(1, "noun", F.col("words")[1]),
            F.when(F.col("k") % 10 != 0, row(1, "size", F.col("size"))),
            F.when(F.col("k") % 5 == 0, row(2, BRAND_ATTR, F.lit("competitor"))))
        return (part.select(F.col("k").cast("string").alias("sku_id"), F.explode(F.array_compact(rows)).alias("r"))
                .select("sku_id", "r.*"))

    def brand_dict(self) -> DataFrame:
        brand = self.table("part").select("p_brand").distinct()
        number = F.split("p_brand", "#")[1]
        ids = F.array_compact(F.array(
            F.when(F.col("p_brand") != "Brand#7", F.concat(F.lit("b"), number)),
            F.when(F.col("p_brand") == "Brand#3", F.concat(F.lit("z"), number))))
        return brand.select(F.explode(ids).alias("brand_id"), F.col("p_brand").alias("brand_name"))

    def category_tree(self) -> DataFrame:
        kind = F.col("p_type")
        return self.table("part").select("p_type").distinct().select(
            F.lit("1").alias("item_first_cate_cd"),
            F.when(kind.isin("ECONOMY", "PROMO", "STANDARD"), "11").otherwise("12").alias("item_second_cate_cd"),
            kind.alias("item_third_cate_cd"), F.lower(kind).alias("item_third_cate_name"))

    def fourth_category(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_type").alias("cid3"),
            F.split("p_name", " ")[1].alias("attr_value"))

    def click_log(self) -> DataFrame:
        day = F.to_date("ts")
        return self.table("events").select(
            F.regexp_extract("props", "([0-9]+)", 1).alias("item_sku_id"),
            F.col("user_id").cast("string").alias("user_log_acct"), F.col("ts").alias("request_tm"),
            day.cast("string").alias("session_id"), F.col("event_type").alias("bs"), day.alias("dt"))
