"""Substitution from click logs: items viewed in one session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.operators import pairs
from basketshift.operators.switching import shares
from basketshift.session import stage

SESSION = ["scope_id", "user_log_acct", "session_id", "request_dt"]


def session_items(views: DataFrame) -> DataFrame:
    """Views per session and item. Repeated views collapse before the shuffle; after it a
    session has one row per item."""
    known = views.dropna(subset=[*SESSION, "item_id"])
    return known.groupBy(*SESSION, "item_id").agg(F.count(F.lit(1)).alias("n"))


def coview_counts(views: DataFrame, size: int) -> DataFrame:
    """Pairs of views per ordered item pair, an item with itself included.

    The count of a pair is the sum over sessions of n_a * n_b. An item with itself needs
    no join. Of two different items only one order is joined; the other is its mirror.
    """
    counted = stage(session_items(views), "session-items")
    alone = counted.groupBy("scope_id", "item_id").agg(F.sum(F.col("n") * F.col("n")).alias("page_views"))
    alone = alone.select("scope_id", F.col("item_id").alias("src_item_id"), F.col("item_id").alias("dst_item_id"), "page_views")
    sized = counted.withColumn("_items", F.count(F.lit(1)).over(Window.partitionBy(*SESSION))).where("_items > 1")
    met = pairs.half_self_join(sized, SESSION, item="item_id", count="_items", values=["n"], size=size)
    half = met.groupBy("scope_id", "item_id_a", "item_id_b").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("page_views"))

    def way(src, dst):
        return F.struct(F.col(src).alias("src_item_id"), F.col(dst).alias("dst_item_id"))

    ways = F.explode(F.array(way("item_id_a", "item_id_b"), way("item_id_b", "item_id_a")))
    apart = half.select("scope_id", ways.alias("w"), "page_views").select("scope_id", "w.*", "page_views")
    return alone.unionByName(apart)


def switching(counts: DataFrame) -> DataFrame:
    """The published switching table."""
    df = shares(counts, "page_views", source="src_item_id")
    return df.select("scope_id", "src_item_id", "dst_item_id", F.col("switch_prob").alias("switching_prob"),
                     F.lit("log").alias("model"))
