"""Attribute importance: which similarities explain switching."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.operators import elastic_net, forest
from basketshift.operators.attributes import DISPLAY_NAMES
from basketshift.operators.blocks import feature_blocks
from basketshift.session import stage
from basketshift.sources import schemas

log = logging.getLogger(__name__)

# Model names in the result.
FOREST = "Random Forest Regression"
ELASTIC_NET = "Elastic Net Regression"


def _fit(maps: DataFrame, weights: Callable[[DataFrame], DataFrame], name: str, failed: list[str] | None) -> DataFrame:
    """The features' weights of all scopes, the largest of each scope being 1; null where no feature has any.

    All scopes are fitted by the same few jobs. If one fails for good, no scope has importances: with ``failed`` its scopes are added to
    that list, without it the error is raised. A scope without usable rows has none either, and is no failure.
    """
    try:
        top = F.max("weight").over(Window.partitionBy("scope_id"))
        return stage(weights(maps).select("scope_id", F.col("name").alias("attdesc"), F.when(top > 0, F.col("weight") / top).alias("Estimate"),
                                          F.lit(name).alias("SimulationType")), "importances")
    except Exception as error:
        if failed is None:
            raise
        log.warning("the fits of all scopes failed: %s", error)
        failed.extend(r["scope_id"] for r in maps.select("scope_id").distinct().collect())
        return maps.sparkSession.createDataFrame([], schemas.struct(schemas.CDT))


def cdt_rf(maps: DataFrame, seed: int = 7, failed: list[str] | None = None) -> DataFrame:
    """Random-forest importances of all scopes. ``maps`` has the pair, switching_prob, fromSales, toSales and sims."""
    p = forest.ForestParams()
    return _fit(maps, lambda m: forest.importances(feature_blocks(m, p.trees, seed), p), FOREST, failed)


def cdt_enet(maps: DataFrame, failed: list[str] | None = None) -> DataFrame:
    """Absolute elastic-net coefficients, of columns of unit variance, of all scopes."""
    return _fit(maps, lambda m: elastic_net.importances(feature_blocks(m, trees=0)), ELASTIC_NET, failed)


def cdt_translate(cdt: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Display names: that of the scope's dropped twin, else the default, else the key itself."""
    default = F.create_map(*[F.lit(x) for kv in DISPLAY_NAMES.items() for x in kv])
    shown = F.coalesce(default[F.col("attdesc")], F.col("attdesc"))
    if names is not None:
        cdt = cdt.join(names.select("scope_id", "names"), "scope_id", "left")
        shown = F.coalesce(F.col("names")[F.col("attdesc")], shown)
    return cdt.select("scope_id", shown.alias("attdesc"), *[c for c in cdt.columns if c not in ("scope_id", "attdesc", "names")])
