"""Attribute importances from a switching result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from basketshift.operators import attributes as A
from basketshift.operators import importance as M
from basketshift.session import stage


@dataclass
class CdtInputs:
    switching: DataFrame
    # (scope_id, attr_key, item_id, attr_val), values as text
    attributes: DataFrame
    # order lines of the extract, for sales
    lines: DataFrame
    scopes: DataFrame | None = None
    ignored: DataFrame | None = None
    brand: DataFrame | None = None
    classify_attr: str | None = None
    exclude: Sequence[str] = ()
    # Net sales by scope and item, where they are not those of ``lines``.
    sales: DataFrame | None = None


class CdtPath:
    def __init__(self, inputs: CdtInputs):
        self.inputs = inputs

    @cached_property
    def attributes(self) -> DataFrame:
        """Written once: the keys, their kinds and the values are read from it."""
        i = self.inputs
        return stage(A.attr_filter(i.attributes, i.scopes, i.classify_attr, i.ignored, i.exclude), "attributes")

    @cached_property
    def kept(self) -> DataFrame:
        """Keys to keep per scope, and the names they are shown under."""
        return stage(A.attr_dedupe(A.attr_keys(self.attributes)), "keys")

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return A.attr_split(A.keep_keys(self.attributes, self.kept))

    @cached_property
    def pairs(self) -> DataFrame:
        return stage(A.pair_base(self.inputs.switching), "pairs")

    @cached_property
    def categorical(self) -> DataFrame:
        return A.attr_categorical(self.pairs, self.split[0])

    @cached_property
    def numeric(self) -> DataFrame:
        return A.attr_numeric(self.pairs, self.split[1])

    @cached_property
    def sales(self) -> DataFrame:
        i = self.inputs
        return i.sales if i.sales is not None else A.item_net_sales(i.lines, i.brand, i.scopes)

    @cached_property
    def with_sales(self) -> DataFrame:
        return A.pair_sales(self.pairs, self.sales)

    @cached_property
    def maps(self) -> DataFrame:
        """Pairs with their sales and all similarities."""
        return A.similarity_maps(self.pairs, *self.split, sales=self.sales)

    def matrix(self, keys: Sequence[str] | None = None) -> DataFrame:
        """The wide matrix of the given keys, or of all that the scopes have."""
        if keys is not None:
            return A.attr_matrix(self.maps, keys)
        return A.attr_matrix(self.staged_maps, A.matrix_keys(self.staged_maps))

    @cached_property
    def staged_maps(self) -> DataFrame:
        return stage(self.maps, "maps")

    @cached_property
    def forest(self) -> DataFrame:
        return M.cdt_rf(self.staged_maps)

    @cached_property
    def forest_and_failed(self) -> tuple[DataFrame, list[str]]:
        """The forests that could be fitted, and the scopes whose fit failed."""
        failed: list[str] = []
        return M.cdt_rf(self.staged_maps, failed=failed), failed

    @cached_property
    def elastic_net(self) -> DataFrame:
        return M.cdt_enet(self.staged_maps)

    def translated(self, cdt: DataFrame) -> DataFrame:
        return M.cdt_translate(cdt, self.kept)
