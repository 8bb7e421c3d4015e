"""Switching probabilities from orders where every scope has its own parameters, all scopes in one job.

Windows, thresholds, item types and what counts as a basket are columns of a table by scope. A window decides which lines a scope
sees; every other parameter joins the small table that uses it: customers, skus, items or scopes. Lines get what they need with
their item.
"""

from __future__ import annotations

from functools import cached_property
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import baskets as B
from basketshift.operators import facts as X
from basketshift.operators import scope as S
from basketshift.operators import switching as W
from basketshift.params import Params
from basketshift.plans.order_path import OrderInputs, OrderPath
from basketshift.session import stage, together


class MixedOrderPath(OrderPath):
    """The steps of :class:`OrderPath`. ``own`` holds parameters by scope_id (see ``scope_params``), ``defaults`` the rest."""

    def __init__(self, inputs: OrderInputs, defaults: Params, own: DataFrame | None = None):
        super().__init__(inputs, defaults)
        self.own = own
        # Thresholds as columns, where operators expect values.
        self.limits = SimpleNamespace(min_baskets=F.col("min_baskets"), max_baskets=F.col("max_baskets"))

    @cached_property
    def scope_params(self) -> DataFrame:
        return stage(S.scope_params(self.scopes, self.p, self.own), "scope-params")

    def with_params(self, df: DataFrame, *names: str) -> DataFrame:
        return df.join(self.scope_params.select("scope_id", *names), "scope_id")

    @property
    def scoped_lines(self) -> DataFrame:
        return X.windowed_facts(self.inputs.lines, self.member, self.scope_params)

    @cached_property
    def mapped_daily(self) -> DataFrame:
        return X.map_items(self.daily, self.kept)

    @cached_property
    def brand(self) -> DataFrame:
        if self.inputs.attributes is None or self.inputs.brands is None:
            return self.inputs.skus.where("false").select("item_sku_id", F.lit(None).cast("string").alias("item_name"), F.lit(None).cast("string").alias("item_id"))
        return X.brand_map(self.inputs.attributes, self.inputs.brands)

    @cached_property
    def customers(self) -> DataFrame:
        return stage(self.with_params(X.customer_orders(self.facts), "min_baskets", "max_baskets"), "customers")

    @cached_property
    def kept(self) -> DataFrame:
        """The skus of each scope without its long tail, with their items and what the line filters need."""
        ranked = self.with_params(X.ranked_skus(self.daily), "prod_tail", "item_type", "non_promo_only", "promo_ratio", "basket_by_day")
        skus = ranked.where((F.col("prod_tail") >= 1) | (F.col("cum_ratio") <= F.col("prod_tail")))
        brands = self.brand.select("item_sku_id", F.col("item_id").alias("brand_id"), F.col("item_name").alias("brand_name"))
        by_sku = F.col("item_type") == "sku"
        return stage(skus.join(brands, "item_sku_id", "left").select(
            "scope_id", "item_sku_id", F.when(by_sku, F.col("item_sku_id")).otherwise(F.col("brand_id")).alias("item_id"), "brand_name", "item_type",
            F.when(F.col("non_promo_only"), F.col("promo_ratio")).alias("promo_ratio"), "basket_by_day"), "kept")

    @cached_property
    def eligible(self) -> DataFrame:
        days = self.mapped_daily.groupBy("scope_id", "item_id", "sale_ord_dt").agg(F.sum("amount").alias("_day"))
        weeks = X.by_week(self.with_params(days, "start_date"), F.col("start_date"))
        judged = weeks.groupBy("scope_id", "item_id").agg(F.sum("_amount").alias("_amount"), F.count_if("_active").alias("_weeks"))
        ok = (C.units("_amount") > F.col("min_sales")) & (F.col("_weeks") >= F.greatest("min_weeks", F.lit(1)))
        return stage(self.with_params(judged, "min_sales", "min_weeks").where(ok).select("scope_id", "item_id"), "eligible")

    @cached_property
    def mapped(self) -> DataFrame:
        return X.map_items(self.facts, self.kept, "promo_ratio", "basket_by_day")

    @cached_property
    def line_filtered(self) -> DataFrame:
        """Mapped lines after the filters that look at one line; a scope without a promotion ratio keeps all positive ones."""
        enough = F.col("after_prefr_amount") >= F.col("promo_ratio").cast("decimal(12,10)") * F.col("before_prefr_amount")
        return X.positive_filter(self.mapped).where(F.col("promo_ratio").isNull() | enough)

    @cached_property
    def purchases(self) -> DataFrame:
        """A basket of a day has the day's start as its time, and no order."""
        _ = self.facts
        together(lambda: self.customers, lambda: self.kept)
        lines = X.drop_hot_strangers(self.line_filtered, self.customers, self.limits)
        by_day = F.col("basket_by_day")
        keyed = lines.withColumns({"sale_ord_tm": F.when(by_day, F.col("sale_ord_dt").cast("timestamp_ntz")).otherwise(F.col("sale_ord_tm")),
                                   "parent_sale_ord_id": F.when(~by_day, F.col("parent_sale_ord_id"))})
        return X.customer_filter(B.purchases(keyed, False), self.customers, self.limits)

    @cached_property
    def baskets(self) -> DataFrame:
        most = self.scope_params.agg(F.max("max_baskets")).first()[0] or 0
        return stage(B.basket_rows(self.purchases, False, most), "baskets")

    @cached_property
    def complement(self) -> DataFrame:
        return W.theil_index(self.rows.where("largest > 1"), self.items)

    @cached_property
    def n_orders(self) -> DataFrame:
        """Orders count as orders also where baskets are days; the lines of those scopes are read once more."""
        lines = X.drop_hot_strangers(self.line_filtered.where("basket_by_day"), self.customers, self.limits)
        daily = X.customer_filter(lines.select("scope_id", "user_id", "parent_sale_ord_id").distinct(), self.customers, self.limits)
        ordered = self.baskets.where("parent_sale_ord_id is not null").select("scope_id", "user_id", "parent_sale_ord_id")
        return W.order_count(ordered.unionByName(daily))

    @cached_property
    def adjusted(self) -> DataFrame:
        return W.adjust(self.measures, self.with_params(self.n_orders, "adjust_for_entropy"), F.col("adjust_for_entropy"))

    @cached_property
    def sku_in_scope(self) -> DataFrame:
        names = self.inputs.skus.select("item_sku_id", "sku_name")
        by_sku = F.col("item_type") == "sku"
        named = self.kept.join(names, "item_sku_id", "left").where(~by_sku | F.col("sku_name").isNotNull())
        return named.select("scope_id", "item_sku_id", "item_id", F.when(by_sku, F.col("sku_name")).otherwise(F.col("brand_name")).alias("item_name"),
                            "item_type").distinct()
