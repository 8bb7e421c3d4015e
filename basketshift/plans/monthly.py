"""What a moved window needs of order lines, kept by month, so that only months whose files changed are read again.

The source is a folder of monthly extracts, ``month=YYYY-MM``. For every month the state holds the lines per category, daily
sales per sku, the orders of each customer, and bitmaps of the orders, skus and customers of each scope. A window is the union of
its whole months and of the days at its edges, which alone are read from the extracts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.operators import distinct as D
from basketshift.operators import facts as X
from basketshift.operators import publish as K
from basketshift.operators import quality as Q
from basketshift.session import stage, staging_apart

# What is counted per scope, by the column that tells it apart.
COUNTED = {"orders": "parent_sale_ord_id", "skus": "item_sku_id", "customers": "user_id"}

TABLES = {
    "coverage": "cid3_of string, n bigint",
    "daily": "scope_id string, item_sku_id string, sale_ord_dt date, qty bigint, amount bigint",
    "buyers": "scope_id string, user_id string, number bigint",
    "sets": "kind string, scope_id string, bucket bigint, bits binary",
}

# What the state needs of a line.
FACTS = (*COUNTED.values(), "sale_ord_dt", "sale_qtty", "before_prefr_amount")

MONTH = "%Y-%m"


def month_end(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def split_window(start: date, end: date) -> tuple[list[str], list[tuple[date, date]]]:
    """The whole months from ``start`` to ``end`` (inclusive), and the ranges of days beside them."""
    months, edges, day = [], [], start
    while day <= end:
        last = month_end(day)
        if day.day == 1 and last <= end:
            months.append(day.strftime(MONTH))
        else:
            edges.append((day, min(last, end)))
        day = last + timedelta(days=1)
    return months, edges


@dataclass
class Changes:
    """What an update read, and the months that it found gone."""

    months: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)


class MonthlyState:
    """State below ``root`` of the extracts in ``extracts``, whose files have ``schema``, for the scopes of ``member`` (scope_id, item_sku_id).

    A month is read again if its files (names, sizes, times) or the members changed. Its tables are shown first and noted as seen last,
    so that an update that was stopped is repeated. Lines without order, sku or customer do not count as one.
    """

    def __init__(self, spark: SparkSession, root: str, extracts: str, schema: str, member: DataFrame):
        self.spark, self.root, self.extracts, self.schema, self.member = spark, root.rstrip("/"), extracts.rstrip("/"), schema, member

    # -- source files --

    def versions(self) -> dict[str, list[list]]:
        """Files of each month with size and time: metadata, as long as the list of files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.extracts).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = {}
        for folder in fs.listStatus(path(self.extracts)):
            name = folder.getPath().getName()
            if name.startswith("month="):
                files = [[f.getPath().toString(), f.getLen(), f.getModificationTime()] for f in fs.listStatus(folder.getPath())
                         if f.getPath().getName()[0] not in "._"]
                found[name[len("month="):]] = sorted(files)
        return found

    def members_mark(self) -> str:
        """Changes with any change of the members."""
        return str(self.member.select("scope_id", "item_sku_id").distinct().agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("scope_id", "item_sku_id").cast("decimal(38,0)"))).first())

    def _seen(self) -> tuple[int, dict]:
        files = K.Files(self.spark, self.root)
        numbers = sorted(int(n.split(".")[0]) for n in files.names("seen"))
        return (numbers[-1], json.loads(files.read(f"seen/{numbers[-1]:010d}.json"))) if numbers else (0, {"months": {}, "members": ""})

    def lines(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files).where("sale_ord_valid_flag = 1")

    # -- update --

    def update(self) -> Changes:
        """Reads the months that changed and replaces their part of the state."""
        number, seen = self._seen()
        now, mark = self.versions(), self.members_mark()
        changed = sorted(m for m, files in now.items() if mark != seen["members"] or files != seen["months"].get(m))
        gone = sorted(set(seen["months"]) - set(now))
        files = [f[0] for m in changed for f in now[m]]
        if not changed and not gone:
            return Changes()
        with staging_apart(self.spark):
            if files:
                lines = self.lines(files).withColumn("dt", F.date_format("sale_ord_dt", "yyyy-MM"))
                facts = stage(lines.select("dt", *FACTS).join(self.member, "item_sku_id"), "changed-facts")
                self._number(facts, number + 1)
                keys = {"cid3": F.lit("all")}
                buyers = stage(self._buyers(facts, "dt"), "changed-buyers")
                parts = {
                    "coverage": lines.groupBy(F.col("cid3").alias("cid3_of"), "dt").agg(F.count(F.lit(1)).alias("n")),
                    "daily": X.sku_daily(facts).withColumn("dt", F.date_format("sale_ord_dt", "yyyy-MM")),
                    "buyers": buyers,
                    "sets": self._sets(facts, "dt", orders=buyers),
                }
            work = [(m, "all") for m in [*changed, *gone]]
            ready = []
            for table, spec in TABLES.items():
                df = parts[table].withColumns(keys) if files else self.spark.createDataFrame([], f"{spec}, dt string, cid3 string")
                ready.append(K.prepare(df, [f"{self.root}/{table}"], work))
            K.commit(self.spark, *ready)
        K.Files(self.spark, self.root).create(f"seen/{number + 1:010d}.json", json.dumps({"months": now, "members": mark}))
        return Changes(changed, files, gone)

    def _number(self, facts: DataFrame, update: int) -> None:
        """Gives numbers to values that have none. They are added to, never replaced; each table's numbers come from one writer at a time."""
        # A name of its own, as a repeated update must not replace what the stopped one gave.
        name = f"{update:010d}-{uuid.uuid4().hex[:8]}"
        for kind, column in COUNTED.items():
            fresh = D.number_new(self._numbers(kind), facts.select(F.col(column).alias("value")))
            K.commit(self.spark, K.prepare(fresh.select("*", F.lit(name).alias("dt"), F.lit(kind).alias("cid3")),
                                           [f"{self.root}/numbers-{kind}"]))

    def _numbers(self, kind: str) -> DataFrame:
        path = f"{self.root}/numbers-{kind}"
        if K.manifest(self.spark, path) is None:
            return self.spark.createDataFrame([], D.NUMBERED)
        return K.read_partitions(self.spark, path, D.NUMBERED).select("value", "number")

    def _numbered(self, facts: DataFrame, kind: str, *keep: str) -> DataFrame:
        """Distinct (scope, number) of a kind, and what else is to be kept."""
        wanted = facts.select("scope_id", *keep, F.col(COUNTED[kind]).alias("value")).distinct()
        return wanted.join(self._numbers(kind), "value").select("scope_id", *keep, "number")

    def _buyers(self, facts: DataFrame, *keep: str) -> DataFrame:
        return self._numbered(facts, "orders", "user_id", *keep)

    def _sets(self, facts: DataFrame, *keep: str, orders: DataFrame | None = None) -> DataFrame:
        """Bitmaps of each kind. Where the orders' numbers are known from the buyers they are not looked up again."""
        out = None
        for kind in COUNTED:
            numbered = orders if kind == "orders" and orders is not None else self._numbered(facts, kind, *keep)
            some = D.bitmaps(numbered, ["scope_id", *keep]).select(F.lit(kind).alias("kind"), "scope_id", "bucket", "bits", *keep)
            out = some if out is None else out.unionByName(some)
        return out

    # -- windows --

    def _months(self, table: str, months: Sequence[str]) -> DataFrame:
        if K.manifest(self.spark, f"{self.root}/{table}") is None:
            return self.spark.createDataFrame([], TABLES[table])
        return K.read_partitions(self.spark, f"{self.root}/{table}", TABLES[table], dt=months).drop("dt", "cid3")

    def _edge(self, first: date, last: date) -> DataFrame | None:
        files = [f[0] for f in self.versions().get(first.strftime(MONTH), [])]
        if not files:
            return None
        return self.lines(files).where(F.col("sale_ord_dt").between(F.lit(first), F.lit(last))).join(self.member, "item_sku_id")

    def _window(self, table: str, start: date, end: date, of_facts) -> DataFrame:
        months, edges = split_window(start, end)
        out = self._months(table, months)
        for first, last in edges:
            facts = self._edge(first, last)
            if facts is not None:
                out = out.unionByName(of_facts(facts).select(out.columns))
        return out

    def scope_counts(self, start: date, end: date) -> DataFrame:
        """Distinct orders, skus and customers per scope, for each kind that has any."""
        return D.merged_count(self._window("sets", start, end, self._sets), ["scope_id", "kind"], "n")

    def customer_orders(self, start: date, end: date) -> DataFrame:
        """Distinct orders per customer. A customer has few, so their numbers are kept and not bitmaps, which would be larger."""
        found = self._window("buyers", start, end, self._buyers)
        return found.distinct().groupBy("scope_id", "user_id").agg(F.count(F.lit(1)).alias("ord_qtty"))

    def daily(self, start: date, end: date) -> DataFrame:
        """As ``facts.sku_daily`` of the window's lines."""
        return self._window("daily", start, end, X.sku_daily)

    def coverage(self, scopes: DataFrame, end: date, n: int = Q.MONTHS) -> DataFrame:
        """As ``quality.month_coverage`` of the extracts."""
        first = end.replace(day=1)
        for _ in range(n - 1):
            first = (first - timedelta(days=1)).replace(day=1)
        months, _ = split_window(first, month_end(end))
        path = f"{self.root}/coverage"
        if K.manifest(self.spark, path) is None:
            counted = self.spark.createDataFrame([], "cid3 string, month date, n bigint")
        else:
            counted = K.read_partitions(self.spark, path, TABLES["coverage"], dt=months).select(
                F.col("cid3_of").alias("cid3"), F.to_date(F.concat("dt", F.lit("-01"))).alias("month"), "n")
        return Q.coverage_of(counted, scopes, end, n)
