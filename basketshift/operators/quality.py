"""Data-quality checks. Codes: 0 good, 1 bad, -1 could not be checked."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators.importance import FOREST

MONTHS = 24
# A result of fewer rows may be constant.
CONSTANT_ROWS = 50


def _scope_categories(scopes: DataFrame) -> DataFrame:
    return scopes.withColumn("cid3", F.explode(C.category_codes("item_third_cate_cd"))).select(
        "scope_id", "cid3", "scope_type", "scope_desc")


def months_back(end: date, n: int = MONTHS):
    """The n months up to that of ``end``, newest first, as an array of first days."""
    last = F.trunc(F.lit(end), "month")
    return F.reverse(F.sequence(F.add_months(last, 1 - n), last, F.expr("interval 1 month")))


def month_coverage(lines: DataFrame, scopes: DataFrame, end: date, n: int = MONTHS) -> DataFrame:
    """Order lines of each scope's categories in each of the last n months; 0 where there are none.

    ``lines`` has cid3 and sale_ord_dt. Lines are counted per category first, then added
    up per scope.
    """
    first, after = F.add_months(F.trunc(F.lit(end), "month"), 1 - n), F.date_add(F.last_day(F.lit(end)), 1)
    recent = lines.where((F.col("sale_ord_dt") >= first) & (F.col("sale_ord_dt") < after))
    return coverage_of(recent.groupBy("cid3", F.trunc("sale_ord_dt", "month").alias("month")).agg(F.count(F.lit(1)).alias("n")), scopes, end, n)


def coverage_of(counted: DataFrame, scopes: DataFrame, end: date, n: int = MONTHS) -> DataFrame:
    """``month_coverage`` from lines counted by cid3 and month."""
    found = counted.join(_scope_categories(scopes), "cid3").groupBy("scope_id", "month").agg(F.sum("n").alias("n"))
    grid = scopes.select("scope_id", F.explode(months_back(end, n)).alias("month"))
    return grid.join(found, ["scope_id", "month"], "left").select("scope_id", "month", F.coalesce("n", F.lit(0)).alias("n_lines"))


def input_check(coverage: DataFrame, skus: DataFrame, attrs: DataFrame, scopes: DataFrame) -> DataFrame:
    """0 if a scope's categories have skus and attributes and no month without orders.

    A month without lines counts as missing: a table, unlike a folder of extracts, cannot
    hold an empty month.
    """
    cats = _scope_categories(scopes)
    per_cat = skus.groupBy("cid3").agg(F.count(F.lit(1)).alias("n_skus"))
    with_attrs = skus.select("item_sku_id", "cid3").join(
        attrs.select(F.col("sku_id").alias("item_sku_id")), "item_sku_id").groupBy("cid3").agg(F.count(F.lit(1)).alias("n_attrs"))
    sizes = (per_cat.join(with_attrs, "cid3", "left").join(cats, "cid3").groupBy("scope_id")
             .agg(F.sum("n_skus").alias("n_skus"), F.sum("n_attrs").alias("n_attrs")))
    gaps = coverage.groupBy("scope_id").agg(F.count_if(F.col("n_lines") == 0).alias("gaps"))
    good = (F.coalesce("n_skus", F.lit(0)) > 0) & (F.coalesce("n_attrs", F.lit(0)) > 0) & (F.col("gaps") == 0)
    return (scopes.select("scope_id").join(gaps, "scope_id", "left").join(sizes, "scope_id", "left")
            .select("scope_id", F.when(good, 0).otherwise(1).alias("input_check")))


def sku_number(scopes: DataFrame, skus: DataFrame, lines: DataFrame, fourth: DataFrame | None = None) -> DataFrame:
    """lvl3: the categories' self skus that were ordered. lvl4: the skus at the scope's value."""
    cats = _scope_categories(scopes)
    ordered = lines.select("item_sku_id").distinct()
    sold = skus.where(F.col("sku_type") == "self").select("item_sku_id", "cid3").distinct().join(ordered, "item_sku_id", "left_semi")
    n3 = (sold.groupBy("cid3").agg(F.count(F.lit(1)).alias("n"))
          .join(cats.where(F.col("scope_type") != "lvl4"), "cid3").groupBy("scope_id").agg(F.sum("n").alias("n")))
    found = n3
    if fourth is not None:
        n4 = (fourth.select("cid3", F.col("attr_value").alias("scope_desc"), "sku_id").distinct()
              .groupBy("cid3", "scope_desc").agg(F.count(F.lit(1)).alias("n"))
              .join(cats.where(F.col("scope_type") == "lvl4"), ["cid3", "scope_desc"])
              .groupBy("scope_id").agg(F.sum("n").alias("n")))
        found = n3.unionByName(n4)
    return scopes.select("scope_id").join(found, "scope_id", "left").select("scope_id", F.coalesce("n", F.lit(0)).alias("sku_number"))


def switch_check(switching: DataFrame, scopes: DataFrame, found_in: str = "scope_id") -> DataFrame:
    """1 if a scope's probabilities leave [0, 1], are all equal, or carry another scope's id.

    ``found_in`` names the column that says which scope's output a row was read from. A
    scope without output passes.
    """
    p = F.col("switching_prob")
    seen = switching.groupBy(F.col(found_in).alias("_scope")).agg(
        F.count_if(~F.col("scope_id").eqNullSafe(F.col(found_in))).alias("foreign"), F.max(p).alias("max_prob"),
        F.min(p).alias("min_prob"), F.count(F.lit(1)).alias("n"))
    bad = ((F.col("foreign") > 0) | (F.col("max_prob") > 1) | (F.col("min_prob") < 0)
           | ((F.col("n") >= CONSTANT_ROWS) & (F.col("max_prob") == F.col("min_prob"))))
    return (scopes.select("scope_id").join(seen.withColumnRenamed("_scope", "scope_id"), "scope_id", "left")
            .select("scope_id", F.when(bad, 1).otherwise(0).alias("switch_check")))


def cdt_check(cdt: DataFrame, scopes: DataFrame, found_in: str = "scope_id", failed: Sequence[str] = ()) -> DataFrame:
    """1 if a scope's forest importances do not peak at 1, hold a null or -inf, or carry another
    scope's id. A scope without output passes, but for those in ``failed``, whose fit failed: they are -1."""
    est = F.col("Estimate")
    seen = cdt.where(F.col("SimulationType") == FOREST).groupBy(F.col(found_in).alias("_scope")).agg(
        F.count_if(~F.col("scope_id").eqNullSafe(F.col(found_in))).alias("foreign"), F.max(est).alias("top"),
        F.min(est).alias("low"), F.count_if(est.isNull()).alias("nulls"))
    bad = ((F.col("foreign") > 0) | ~F.col("top").eqNullSafe(F.lit(1.0)) | (F.col("low") == float("-inf")) | (F.col("nulls") > 0))
    seen = seen.select(F.col("_scope").alias("scope_id"), F.coalesce(bad, F.lit(True)).alias("_bad"))
    return scopes.select("scope_id").join(seen, "scope_id", "left").select(
        "scope_id", F.when(F.col("scope_id").isin(*failed), -1).when(F.col("_bad"), 1).otherwise(0).alias("cdt_check"))


def status_table(inputs: DataFrame, numbers: DataFrame, switches: DataFrame, cdts: DataFrame) -> DataFrame:
    """One text row per scope; status 0 only if all three checks are 0. Bad inputs fail everything."""
    df = inputs.join(numbers, "scope_id", "left").join(switches, "scope_id", "left").join(cdts, "scope_id", "left")
    fed = F.col("input_check") == 0

    def code(name, otherwise):
        return F.when(fed, F.coalesce(F.col(name).cast("string"), F.lit("-1"))).otherwise(otherwise).alias(name)

    good = fed & (F.col("switch_check") == 0) & (F.col("cdt_check") == 0)
    return df.select("scope_id", F.col("input_check").cast("string").alias("input_check"), code("sku_number", "-1"),
                     code("switch_check", "1"), code("cdt_check", "1"), F.when(good, "0").otherwise("1").alias("status"))


def publish_gate(results: DataFrame, checks: DataFrame, check: str, whole_batch: bool = False) -> DataFrame:
    """Results of the scopes that passed ``check``; with ``whole_batch``, all or nothing."""
    if whole_batch:
        worst = checks.agg(F.max(F.abs(check))).scalar()
        return results.where(worst == 0)
    return results.join(checks.where(F.col(check) == 0).select("scope_id"), "scope_id", "left_semi")
