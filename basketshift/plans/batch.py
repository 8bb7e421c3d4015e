"""One batch: pending categories to checked, published results, all scopes in one pass."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.operators import attributes as A
from basketshift.operators import facts as X
from basketshift.operators import publish as K
from basketshift.operators import quality as Q
from basketshift.operators import scope as S
from basketshift.params import Params
from basketshift.plans.cdt_path import CdtInputs, CdtPath
from basketshift.plans.log_path import LogInputs, LogPath
from basketshift.plans.mixed_path import MixedOrderPath
from basketshift.plans.order_path import OrderInputs, OrderPath
from basketshift.session import stage, staging_apart
from basketshift.sources import readers as R
from basketshift.sources import schemas
from basketshift.sources.readers import INTEREST_CODES


log = logging.getLogger(__name__)


@dataclass
class BatchInputs:
    """``lines`` carries cid3 besides the order columns.

    ``params`` gives categories parameters of their own: cid3 as in the work list, and any columns of SCOPE_PARAMS but the dates, window_months
    (the length of the window that ends on the day of the work), self_pop, scope_type and source (ord or log). Where it has no row, no such
    column or a null, the parameters and options of the batch count.
    """

    lines: DataFrame
    skus: DataFrame
    tree: DataFrame
    attributes: DataFrame
    brands: DataFrame
    fourth: DataFrame
    clicks: DataFrame | None = None
    ignored: DataFrame | None = None
    extended: DataFrame | None = None
    params: DataFrame | None = None


@dataclass
class Parts:
    """Results of scopes that were computed by several paths."""

    paths: list[OrderPath | LogPath]

    def _all(self, name: str) -> DataFrame:
        parts = [getattr(p, name) for p in self.paths]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    @cached_property
    def switching(self) -> DataFrame:
        return self._all("switching")

    @cached_property
    def sku_in_scope(self) -> DataFrame:
        return self._all("sku_in_scope")

    @property
    def orders(self) -> OrderPath | None:
        return next((p for p in self.paths if isinstance(p, OrderPath)), None)


@dataclass(frozen=True)
class BatchOptions:
    self_pop: str = "self"
    scope_type: str = "lvl3"
    classify_attr: str | None = None
    # order lines ("ord") or the click log ("log")
    source: str = "ord"
    codes: Sequence[str] = INTEREST_CODES
    # attributes from the extended table, already restricted to the day and data types
    ext_attr: bool = False


def extended_as_attributes(extended: DataFrame) -> DataFrame:
    """Extended attributes in the shape of the curated ones, all of our own site."""
    return extended.select(F.col("item_sku_id").alias("sku_id"), F.lit(1).alias("web_id"), F.col("com_attr_name").alias("attr_name"),
                           F.col("com_attr_value_name").alias("attr_value"))


class Batch:
    def __init__(self, spark: SparkSession, control: str, root: str, inputs: BatchInputs, params: Params, options: BatchOptions):
        self.spark, self.control, self.root = spark, control, root
        self.inputs, self.p, self.o = inputs, params, options

    def _by_category(self, df: DataFrame, *names: str) -> DataFrame:
        """Adds the categories' own parameters, or the options of the batch."""
        own, given = self.inputs.params, df
        held = [n for n in names if own is not None and n in own.columns]
        if held:
            given = df.join(own.select(F.col("cid3").alias("item_third_cate_cd"), *[F.col(n).alias(f"_{n}") for n in held]), "item_third_cate_cd", "left")

        def default(n):
            return F.lit(getattr(self.p if n == "item_type" else self.o, n))

        return given.select(*df.columns, *[(F.coalesce(f"_{n}", default(n)) if n in held else default(n)).alias(n) for n in names if n not in df.columns])

    def scopes(self, work: DataFrame) -> DataFrame:
        i, o = self.inputs, self.o
        lists = S.category_enrich(work.select(F.col("cid3").alias("item_third_cate_cd")).distinct(), i.tree)
        whole = S.scope_table(self._by_category(lists, "self_pop", "item_type"), F.col("self_pop"), F.col("item_type"))
        if o.classify_attr is None:
            return whole
        kinds = stage(self._by_category(lists, "scope_type").select("item_third_cate_cd", "scope_type"), "kinds")

        def of(kind):
            return whole.join(kinds.where(F.col("scope_type") == kind).select("item_third_cate_cd"), "item_third_cate_cd", "left_semi").select(*whole.columns)

        return of("lvl3").unionByName(S.lvl4_scopes(of("lvl4"), i.skus, self.attributes, o.classify_attr))

    def own_params(self, scopes: DataFrame) -> DataFrame:
        """The parameters of each scope that its category has of its own, with a window that ends on this batch's day."""
        own = self.inputs.params
        named = [c for c in own.columns if c not in ("cid3", "self_pop", "item_type", "scope_type", "source", "window_months")]
        months = [C.window_start_months(F.lit(self.p.end_date), F.col("window_months")).alias("start_date")] if "window_months" in own.columns else []
        return scopes.join(own, scopes["item_third_cate_cd"] == own["cid3"]).select(scopes["scope_id"], *named, *months)

    @property
    def attributes(self) -> DataFrame:
        return extended_as_attributes(self.inputs.extended) if self.o.ext_attr else self.inputs.attributes

    def _paths(self, scopes: DataFrame) -> Parts:
        """One order path for all scopes of orders, one click path for each item type."""
        i = self.inputs
        if i.params is None:
            kinds = [(self.o.source, self.p.item_type)]
            told = scopes
        else:
            told = stage(self._by_category(scopes, "source"), "sources")
            kinds = sorted({(r["source"], r["item_type"] if r["source"] == "log" else "any") for r in told.select("source", "item_type").distinct().collect()})

        def path(source, item_type):
            mine = told if i.params is None else told.where(F.col("source") == source)
            if source == "log":
                mine = mine.where(F.col("item_type") == item_type).select(*scopes.columns)
                return LogPath(LogInputs(i.clicks, i.skus, mine, i.attributes, i.brands, i.fourth), replace(self.p, item_type=item_type), self.o.codes)
            inputs = OrderInputs(i.lines, i.skus, mine.select(*scopes.columns), i.attributes, i.brands, i.fourth)
            return OrderPath(inputs, self.p) if i.params is None else MixedOrderPath(inputs, self.p, self.own_params(scopes))

        return Parts([path(*k) for k in kinds])

    def run(self, pending: DataFrame | None = None) -> DataFrame | None:
        """Computes, checks and publishes the pending categories, each for its own day; returns the status rows.

        A day's analysis has the window of the parameters, moved so that it ends on that day. Work is marked done only after
        the results of its day are published, so a lost run is repeated, and repeating it overwrites the same partitions.
        A category with a scope whose fit failed is not marked and keeps the importances it has.
        """
        with staging_apart(self.spark):
            control = K.read_partitions(self.spark, self.control, "status string")
            work = stage(R.pending_scopes(control if pending is None else pending), "work")
            days = [r["dt"] for r in work.select("dt").distinct().orderBy("dt").collect()]
            found = [self._for_day(day)._run_day(work.where(F.col("dt") == day)) for day in days]
        out = None
        for status in found:
            out = status if out is None else out.unionByName(status)
        return out

    def _for_day(self, day: str) -> Batch:
        end = date.fromisoformat(day)
        window = replace(self.p, end_date=end, start_date=self.p.start_date + (end - self.p.end_date))
        return Batch(self.spark, self.control, self.root, self.inputs, window, self.o)

    def _run_day(self, work: DataFrame) -> DataFrame:
        i, p = self.inputs, self.p
        scopes = stage(self.scopes(work), "scopes")
        categories = [r["cid3"] for r in work.select("cid3").distinct().collect()]
        recent = R.order_scan(i.lines, F.add_months(F.trunc(F.lit(p.end_date), "month"), 1 - Q.MONTHS), p.end_date)
        coverage = Q.month_coverage(i.lines.where("sale_ord_valid_flag = 1"), scopes, p.end_date)
        inputs = self._codes("input_check", scopes, lambda: Q.input_check(coverage, i.skus, self.attributes, scopes))
        numbers = self._codes("sku_number", scopes, lambda: Q.sku_number(scopes, i.skus, recent, i.fourth))
        if inputs is None:
            return self._unreadable(work, scopes, categories)
        if numbers is None:
            numbers = scopes.select("scope_id", F.lit(-1).alias("sku_number"))
        path = self._paths(scopes)
        # Pairs are expanded once: what is published besides is read from what is written here.
        if path.orders:
            path.orders.detail = stage(path.orders.detail, "detail")
        switching = path.switching = stage(path.switching, "switching")
        member = S.membership(scopes, i.skus, i.fourth)
        scoped = A.scoped_attributes(self.attributes, member)
        by_sku, by_brand = (scopes.where(F.col("item_type") == t) for t in ("sku", "brand"))
        brand = X.brand_map(i.attributes, i.brands)
        # Where items are brands, they take over the attributes of their skus.
        ids = brand.where("item_id is not null").select(F.col("item_sku_id").alias("item_id"), F.col("item_id").alias("brand_id"))
        own = scoped.join(by_brand.select("scope_id"), "scope_id", "left_semi").join(ids, "item_id").drop("item_id").withColumnRenamed("brand_id", "item_id")
        scoped = scoped.join(by_sku.select("scope_id"), "scope_id", "left_semi").unionByName(own)
        lines = R.order_scan(i.lines, p.start_date, p.end_date)
        sales = A.item_net_sales(lines, None, by_sku).unionByName(A.item_net_sales(lines, brand, by_brand))
        cdt = CdtPath(CdtInputs(switching, scoped, lines, scopes, i.ignored, classify_attr=self.o.classify_attr, sales=sales))
        forests, failed = cdt.forest_and_failed
        importances = stage(forests, "cdt")
        # Fits that failed may succeed when repeated: their categories stay pending and keep the importances they have.
        held = sorted({K.category_of(s) for s in failed})

        switches, cdts = Q.switch_check(switching, scopes), Q.cdt_check(importances, scopes, failed=failed)
        status = stage(Q.status_table(inputs, numbers, switches, cdts), "status")
        self._publish(scopes, status, switching, importances, cdt, path, categories, held)
        K.mark_done(self.control, work.where(~F.col("cid3").isin(*held)))
        if held:
            self._reopen(work.where(F.col("cid3").isin(*held)))
        return self._published_status(status, categories)

    def _published_status(self, status: DataFrame, categories: list[str]) -> DataFrame:
        """What the batch staged goes when it ends; its status is read from where it is published."""
        return K.read_partitions(self.spark, f"{self.root}/status", schemas.STATUS, dt=str(self.p.publish_date), cid3=categories).select(status.columns)

    def _reopen(self, work: DataFrame) -> None:
        """Written anew, so that a watcher, which sees each row once, starts it again."""
        K.overwrite_partitions(work.select(F.lit("0").alias("status"), *K.PARTITION), self.control)

    def _codes(self, name: str, scopes: DataFrame, check: Callable[[], DataFrame]) -> DataFrame | None:
        """The codes of a check; None if its inputs cannot be read."""
        try:
            return stage(check(), name)
        except (PySparkException, Py4JJavaError) as error:
            log.warning("%s of %d scopes could not be found: %s", name, scopes.count(), error)
            return None

    def _unreadable(self, work: DataFrame, scopes: DataFrame, categories: list[str]) -> DataFrame:
        """Status -1 for all scopes. Nothing else is published, results stay as they are, and the work stays pending."""
        none = scopes.select("scope_id")
        status = stage(Q.status_table(none.withColumn("input_check", F.lit(-1)), none.withColumn("sku_number", F.lit(-1)),
                                      none.withColumn("switch_check", F.lit(1)), none.withColumn("cdt_check", F.lit(1))), "status")
        ready = K.prepare(K.with_partition(status, self.p.publish_date), [f"{self.root}/status_tmp", f"{self.root}/status"])
        K.commit(self.spark, ready)
        self._reopen(work)
        return self._published_status(status, categories)

    def _publish(self, scopes, status, switching, importances, cdt, path, categories, held=()) -> None:
        day = self.p.publish_date
        fed = status.where("input_check = '0'")

        def passed(df, check):
            return K.with_partition(Q.publish_gate(df, fed, check), day)

        def table(name):
            return [f"{self.root}/{name}{suffix}" for suffix in ("_tmp", "_pre", "")]

        work = [(str(day), c) for c in categories]
        ready = [K.prepare(passed(switching, "switch_check"), table("switching_prob"), work)]
        # With the keys as they are, and under the names they are shown by.
        fitted = [(day, c) for day, c in work if c not in held]
        for rows, name in ((importances, "cdt_raw"), (cdt.translated(importances), "cdt")):
            ready.append(K.prepare(passed(rows, "cdt_check").where(~F.col("cid3").isin(*held)), table(name), fitted))
        outputs = {"scope": [S.scope_descriptor(scopes)], "sku_in_scope": [path.sku_in_scope]}
        if path.orders:
            outputs["spendswitch"] = [path.orders.detail]
        ready += K.prepare_results(outputs, self.p.end_date, self.root, categories).values()
        ready.append(K.prepare(K.with_partition(status, day), table("status")[::2]))
        # All rows are written; what follows are renames of small files.
        K.commit(self.spark, *ready)
        for p in ready:
            K.vacuum(self.spark, p.paths)
