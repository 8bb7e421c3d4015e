"""Switching probabilities from orders, all scopes in one job."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from basketshift.operators import baskets as B
from basketshift.operators import facts as X
from basketshift.operators import scope as S
from basketshift.operators import switching as W
from basketshift.params import Params
from basketshift.session import require, stage, together


@dataclass
class OrderInputs:
    lines: DataFrame
    skus: DataFrame
    scopes: DataFrame
    attributes: DataFrame | None = None
    brands: DataFrame | None = None
    fourth: DataFrame | None = None


class OrderPath:
    """The steps, each available by itself.

    Tables that several later steps read are staged: scopes, facts, daily sales, customers,
    kept skus, eligible items, baskets, items and the basket rows in scope.
    """

    def __init__(self, inputs: OrderInputs, params: Params):
        self.inputs = inputs
        self.p = params
        require(inputs.lines.sparkSession)

    @cached_property
    def scopes(self) -> DataFrame:
        return stage(self.inputs.scopes, "scopes")

    @cached_property
    def member(self) -> DataFrame:
        return S.membership(self.scopes, self.inputs.skus, self.inputs.fourth)

    @property
    def scoped_lines(self) -> DataFrame:
        return X.scope_facts(self.inputs.lines, self.member, self.p)

    @cached_property
    def facts(self) -> DataFrame:
        return stage(self.scoped_lines, "facts")

    @cached_property
    def brand(self) -> DataFrame | None:
        if self.p.item_type == "sku":
            return None
        return X.brand_map(self.inputs.attributes, self.inputs.brands)

    @cached_property
    def customers(self) -> DataFrame:
        return stage(X.customer_orders(self.facts), "customers")

    @cached_property
    def daily(self) -> DataFrame:
        """From the facts if they are written already. If not, the lines are summed where they meet their scopes, and only what is summed moves."""
        return stage(X.sku_daily(self.facts if "facts" in self.__dict__ else self.scoped_lines), "daily")

    @cached_property
    def kept(self) -> DataFrame:
        """The skus of each scope without the long tail, with their items."""
        return stage(X.with_items(X.kept_skus(self.daily, self.p), self.p, self.brand), "kept")

    @cached_property
    def mapped_daily(self) -> DataFrame:
        return X.map_skus(self.daily, self.kept) if self.p.item_type == "sku" else X.map_items(self.daily, self.kept)

    @cached_property
    def eligible(self) -> DataFrame:
        found = X.eligible_skus(self.daily, self.kept, self.p) if self.p.item_type == "sku" else X.eligible_items(self.mapped_daily, self.p)
        return stage(found, "eligible")

    @cached_property
    def mapped(self) -> DataFrame:
        return X.map_items(self.facts, self.kept)

    @cached_property
    def line_filtered(self) -> DataFrame:
        """Mapped lines after the filters that look at one line."""
        if self.p.non_promo_only:
            return X.nonpromo_filter(self.mapped, self.p.promo_ratio)
        return X.positive_filter(self.mapped)

    @cached_property
    def purchases(self) -> DataFrame:
        _ = self.facts
        together(lambda: self.customers, lambda: self.kept)
        lines = X.drop_hot_strangers(self.line_filtered, self.customers, self.p)
        return X.customer_filter(B.purchases(lines, self.p.basket_by_day), self.customers, self.p)

    @cached_property
    def baskets(self) -> DataFrame:
        return stage(B.basket_rows(self.purchases, self.p.basket_by_day, self.p.max_baskets), "baskets")

    @cached_property
    def items(self) -> DataFrame:
        _ = self.purchases
        together(lambda: self.baskets, lambda: self.eligible)
        return stage(W.items_in_scope(self.baskets, self.eligible), "items")

    @cached_property
    def rows(self) -> DataFrame:
        return stage(W.scoped_rows(self.baskets, self.items), "rows")

    @cached_property
    def theil(self) -> DataFrame:
        return W.theil_index(self.rows, self.items)

    @cached_property
    def adjacent(self) -> DataFrame:
        return W.adjacent_pairs(self.rows, self.p.block_items)

    @cached_property
    def complement(self) -> DataFrame | None:
        """The complement index of the customers who have one: only those with a basket of several items have within-basket pairs."""
        return W.theil_index(self.rows.where("largest > 1"), self.items) if self.p.adjust_for_entropy else None

    @cached_property
    def within(self) -> DataFrame:
        return W.within_pairs(self.rows, self.p.block_items, self.complement)

    @cached_property
    def measures(self) -> DataFrame:
        return W.pair_measures(self.rows, self.p.block_items, self.complement)

    @cached_property
    def n_orders(self) -> DataFrame:
        """Orders count as orders also where baskets are days; those lines are read once more."""
        if not self.p.basket_by_day:
            return W.order_count(self.baskets)
        lines = X.drop_hot_strangers(self.line_filtered, self.customers, self.p)
        orders = lines.select("scope_id", "user_id", "parent_sale_ord_id").distinct()
        return W.order_count(X.customer_filter(orders, self.customers, self.p))

    @cached_property
    def adjusted(self) -> DataFrame:
        return W.adjust(self.measures, self.n_orders, self.p.adjust_for_entropy)

    @cached_property
    def detail(self) -> DataFrame:
        return W.spendswitch_detail(self.adjusted)

    @cached_property
    def switching(self) -> DataFrame:
        return W.switching(self.detail)

    @cached_property
    def sku_in_scope(self) -> DataFrame:
        return X.sku_in_scope(self.kept, self.p, self.inputs.skus)
