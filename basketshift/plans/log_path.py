"""Switching probabilities from click logs, all scopes in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from basketshift.operators import coview
from basketshift.operators import facts as X
from basketshift.operators import scope as S
from basketshift.params import Params
from basketshift.session import require, stage
from basketshift.sources.readers import INTEREST_CODES, view_scan


@dataclass
class LogInputs:
    clicks: DataFrame
    skus: DataFrame
    scopes: DataFrame
    attributes: DataFrame | None = None
    brands: DataFrame | None = None
    fourth: DataFrame | None = None


class LogPath:
    def __init__(self, inputs: LogInputs, params: Params, codes: Sequence[str] = INTEREST_CODES):
        self.inputs = inputs
        self.p = params
        self.codes = codes
        require(inputs.clicks.sparkSession)

    @cached_property
    def scopes(self) -> DataFrame:
        return stage(self.inputs.scopes, "scopes")

    @cached_property
    def brand(self) -> DataFrame | None:
        if self.p.item_type == "sku":
            return None
        return X.brand_map(self.inputs.attributes, self.inputs.brands)

    @cached_property
    def views(self) -> DataFrame:
        member = S.membership(self.scopes, self.inputs.skus, self.inputs.fourth)
        seen = view_scan(self.inputs.clicks, self.p.end_date, self.codes).join(member, "item_sku_id")
        return X.with_items(seen, self.p, self.brand).where("item_id is not null").select(
            "scope_id", "user_log_acct", "session_id", "request_dt", "item_id")

    @cached_property
    def counts(self) -> DataFrame:
        return coview.coview_counts(self.views, self.p.block_items)

    @cached_property
    def switching(self) -> DataFrame:
        return coview.switching(self.counts)

    @cached_property
    def sku_in_scope(self) -> DataFrame:
        return X.log_sku_in_scope(self.switching, self.inputs.skus, self.p, self.brand)
