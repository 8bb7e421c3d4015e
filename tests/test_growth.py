"""What moves and is written must grow no faster than the input: plans of the steps that many queries share, and that their results are whole."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from basketshift.operators import attributes as A
from basketshift.operators import facts as X
from basketshift.plans import catalog
from basketshift.session import stage
from basketshift.sources.star import Star
from tests.test_plans import FOLDER, formatted, physical

TEXT = "scope_id string, attr_key string, item_id string, attr_val string"
PAIRS = "scope_id string, src_item_id string, dst_item_id string, switching_prob double"


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_lines_meet_orders_as_they_are_stored(spark, unbroadcast):
    plan = formatted(Star(spark, FOLDER).order_lines().select("item_sku_id", "parent_sale_ord_id", "before_prefr_amount", "after_prefr_amount", "sale_ord_dt"))
    inputs = re.findall(r"Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert len(inputs) == 2
    assert {re.sub(r"#\d+L?", "", c) for i in inputs for c in i.split(", ")} == {
        "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "o_orderkey", "o_orderdate"}


def test_daily_sales_without_facts(spark, unbroadcast):
    """Where nothing else needs the facts they are not written, and lines are summed where they meet their scopes."""
    path, other = (catalog.order_path(spark, FOLDER) for _ in range(2))
    plan = physical(X.sku_daily(path.scoped_lines))
    assert not re.search(r"Exchange hashpartitioning\([^)]*sale_ord_dt", plan), plan
    alone = path.daily
    assert "facts" not in path.__dict__
    _ = other.facts
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, other.daily.collect()))


def test_daily_sales_move_once_to_be_judged(spark, unbroadcast):
    path = catalog.order_path(spark, FOLDER)
    assert moved(physical(X.eligible_items(path.mapped_daily, path.p))) == 2
    by_items = X.eligible_items(X.map_items(path.daily, path.kept), path.p)
    assert sorted(map(tuple, path.eligible.collect())) == sorted(map(tuple, by_items.collect()))


def test_skus_are_judged_before_the_tail_is_cut(spark, unbroadcast):
    """Where an item is its sku, what meets the kept skus is one row a sku, not its days; the tail stays out though it would pass."""
    rows = [("s", sku, date(2020, 1, 1 + 7 * w + d), 1, amount * 10_000) for sku, amount in (("A", 50), ("B", 50), ("C", 1)) for w in range(3) for d in (0, 1)]
    rows += [("s", "D", date(2020, 1, 1), 1, 10_000_000), ("t", "A", date(2020, 1, 1), 1, 500_000), ("s", "E", date(2020, 1, 1), 1, 9_000_000),
             ("s", "E", date(2020, 1, 8), 1, -9_000_000), ("s", "E", date(2020, 1, 15), 1, 9_000_000)]
    daily = spark.createDataFrame(rows, "scope_id string, item_sku_id string, sale_ord_dt date, qty long, amount long").repartition(3)
    kept = spark.createDataFrame([("s", x, x) for x in "ACDE"], "scope_id string, item_sku_id string, item_id string")
    p = replace(catalog.params(), start_date=date(2020, 1, 1), end_date=date(2020, 1, 31), min_sales=200, min_weeks=3)
    found = X.eligible_skus(daily, kept, p)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in X.eligible_items(X.map_skus(daily, kept), p).collect()} == {("s", "A")}
    path = catalog.order_path(spark, FOLDER)
    given = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr("basketshift.plans.order_path.stage", lambda df, label, **kw: (label == "eligible" and given.append(df)) or stage(df, label, **kw))
        _ = path.eligible
    plan = physical(given[0])
    assert moved(plan) == 2 and 0 <= plan.find("SortMergeJoin") < plan.find("HashAggregate"), plan


def test_pairs_move_once_for_their_sums_and_shares(spark, unbroadcast):
    plan = physical(catalog.order_path(spark, FOLDER).detail)
    by_source = re.findall(r"Exchange hashpartitioning\(scope_id#\d+, src#\d+(?:, dst#\d+)?, \d+\)", plan)
    assert len(by_source) == 1, plan


def test_windows_do_not_multiply_members(spark, unbroadcast):
    lines = spark.createDataFrame(
        [("u", str(n), sku, day, 1.0, 2.0, 2.0, 1) for n, (sku, day) in enumerate(
            [("A", date(2020, 1, 31)), ("A", date(2020, 2, 1)), ("A", date(2020, 2, 29)), ("A", date(2020, 3, 1)), ("B", date(2020, 2, 10))])],
        "user_id string, parent_sale_ord_id string, item_sku_id string, sale_ord_dt date, sale_qtty double, before_prefr_amount double, "
        "after_prefr_amount double, sale_ord_valid_flag int").withColumn("sale_ord_tm", F.col("sale_ord_dt").cast("timestamp_ntz"))
    member = spark.createDataFrame([("s", "A"), ("t", "A"), ("t", "B"), ("never", "B")], "scope_id string, item_sku_id string")
    windows = spark.createDataFrame([("s", date(2020, 1, 31), date(2020, 2, 1)), ("t", date(2020, 2, 1), date(2020, 2, 29)),
                                     ("never", date(2020, 3, 1), date(2020, 2, 1))], "scope_id string, start_date date, end_date date")
    found = X.windowed_facts(lines, member, windows)
    assert sorted((r["scope_id"], r["item_sku_id"], r["sale_ord_dt"].isoformat()) for r in found.collect()) == [
        ("s", "A", "2020-01-31"), ("s", "A", "2020-02-01"), ("t", "A", "2020-02-01"), ("t", "A", "2020-02-29"), ("t", "B", "2020-02-10")]
    assert "Generate" not in physical(found)


def test_split_attributes_are_made_once(spark):
    rows = [("s", "n", "A", "1.5"), ("s", "m", "A", "1"), ("s", "m", "B", "one"), ("s", "e", "A", None)]
    attrs = spark.createDataFrame(rows, TEXT).repartition(3, "item_id")
    cat, num = A.attr_split(attrs)
    for df in (cat, num, cat.unionByName(num.withColumn("attr_val", F.col("attr_val").cast("string")))):
        assert "item_id#" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", physical(df)))
    assert {tuple(r) for r in cat.collect()} == {("s", "m", "A", "1"), ("s", "m", "B", "one"), ("s", "e", "A", None)}
    assert {tuple(r) for r in num.collect()} == {("s", "n", "A", 1.5)}


def test_sales_of_the_facts(spark):
    """Lines that stand once in each scope give each scope its own sales."""
    lines = spark.createDataFrame([("s", "A", 1.0), ("s", "A", 2.0), ("t", "A", 1.0), ("t", "A", 2.0), ("t", "B", 4.0)],
                                  "scope_id string, item_sku_id string, after_prefr_amount double")
    assert {tuple(r) for r in A.item_net_sales(lines).collect()} == {("s", "A", 3.0), ("t", "A", 3.0), ("t", "B", 4.0)}


def test_sales_by_category_are_summed_before_skus_are_looked_up(spark, unbroadcast):
    """The same as from lines with their category, of skus that the master lists twice or in two categories too."""
    lines = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("B", 4.0), ("C", 8.0), ("D", 16.0)], "item_sku_id string, after_prefr_amount double")
    skus = spark.createDataFrame([("A", "x"), ("B", "x"), ("B", "x"), ("C", "x"), ("C", "y")], "item_sku_id string, cid3 string")
    brand = spark.createDataFrame([(k, "b") for k in "ABCD"], "item_sku_id string, item_id string")
    scopes = spark.createDataFrame([("s", "x"), ("t", "x-y")], "scope_id string, item_third_cate_cd string")
    found = A.item_net_sales(lines, brand, scopes, skus)
    want = A.item_net_sales(lines.join(skus, "item_sku_id"), brand, scopes)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in want.collect()} == {("s", "b", 19.0), ("t", "b", 27.0)}
    assert not re.search(r"Exchange hashpartitioning\(cid3#\d+, item_sku_id", physical(found))


def test_pairs_move_once_for_each_end(spark, unbroadcast):
    """Sales and attributes of an end are looked up together, and both are what they are by themselves."""
    pairs = spark.createDataFrame([("s", a, b, 0.5) for a, b in ("AB", "AC", "BA", "CA")] + [("t", "A", "B", 0.1), ("bare", "A", "B", 0.1)], PAIRS)
    texts = spark.createDataFrame([("s", "colour", "A", "red"), ("s", "colour", "B", "red"), ("s", "gone", "C", None), ("t", "gone", "Z", "x")], TEXT)
    numbers = spark.createDataFrame([("s", "size", "A", 1.0), ("s", "size", "B", 3.0)], "scope_id string, attr_key string, item_id string, attr_val double")
    sales = spark.createDataFrame([("s", "A", 10.0), ("s", "B", 30.0), ("t", "A", 7.0)], "scope_id string, item_id string, sales double")
    keys = A._keys(texts, numbers)
    plan = physical(A._with_ends(pairs, sales, A._profiles(A._collapsed(texts, numbers), keys)))
    # The pairs, the sales and the profiles, for each end.
    assert len(re.findall(r"Exchange hashpartitioning\(scope_id#\d+, (?:src|dst)_item_id#\d+, \d+\)", plan)) == 6, plan
    joined = {(r["scope_id"], r["src_item_id"], r["dst_item_id"]): r for r in A.similarity_maps(pairs, texts, numbers, sales).collect()}
    alone = A.similarity_maps(pairs, texts, numbers).collect()
    assert {k: v["sims"] for k, v in joined.items()} == {(r["scope_id"], r["src_item_id"], r["dst_item_id"]): r["sims"] for r in alone}
    nets = {(r["scope_id"], r["src_item_id"], r["dst_item_id"]): (r["fromSales"], r["toSales"]) for r in A.pair_sales(pairs, sales).collect()}
    assert {k: (v["fromSales"], v["toSales"]) for k, v in joined.items()} == {k: nets[k] for k in joined}
    # A scope without attributes has no similarities; one whose items have none of its keys has equal ones.
    assert len(joined) == 5 and joined["t", "A", "B"]["sims"] == {"gone": 1.0} and joined["t", "A", "B"]["toSales"] is None
    # Beside C, whose value is null, the pairs of equal items count 1 and all others 0.
    assert joined["s", "A", "B"]["sims"] == pytest.approx({"colour": 1.0, "gone": 1.0, "size": 0.0})
    assert joined["s", "C", "A"]["sims"] == pytest.approx({"colour": 0.0, "gone": 0.5, "size": 0.0})
