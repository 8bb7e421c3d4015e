"""Plan shapes that must hold at any scale."""

from __future__ import annotations

import re

import pytest

from basketshift.operators import baskets as B
from basketshift.operators import facts as X
from basketshift.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def path(spark):
    return catalog.order_path(spark, FOLDER)


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """Plans as they are once no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def steps(path):
    clicks = catalog.log_path(path.inputs.scopes.sparkSession, FOLDER)
    return {
        "facts": X.scope_facts(path.inputs.lines, path.member, path.p), "customers": X.customer_orders(path.facts),
        "daily": X.sku_daily(path.facts), "eligible": X.eligible_items(path.mapped_daily, path.p), "baskets": B.basket_rows(path.purchases, False), "theil": path.theil, "adjacent": path.adjacent,
        "within": path.within, "measures": path.measures, "detail": path.detail, "sku_in_scope": path.sku_in_scope,
        "coview": clicks.counts, "log": clicks.switching,
    }


def test_no_cross_joins_no_global_windows_no_python(path, unbroadcast):
    for name, df in steps(path).items():
        plan = physical(df)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert word not in plan, (name, word)
        # Only a grand total, one partial row per task, ends on a single partition.
        for child in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
            assert "HashAggregate(keys=[], functions=[partial_" in child, (name, child)
        for spec in re.findall(r"Window \[.*", plan):
            assert re.search(r"windowspecdefinition\(scope_id#", spec), (name, spec)


def test_only_bounded_sides_are_broadcast(path, unbroadcast):
    """With automatic broadcasts off, only hints remain: slice offsets and hot customers, each with a proven bound."""
    hinted = {name: physical(df).count("BroadcastHashJoin") for name, df in steps(path).items()}
    assert hinted["facts"] == 0 and hinted["adjacent"] == 0 and hinted["coview"] == 0 and hinted["customers"] == 0
    assert hinted["theil"] == 0 and hinted["within"] == 0 and hinted["detail"] == 0


def test_shuffles_of_order_lines(path, unbroadcast):
    """From facts to baskets, lines move by sku (tail cut and mapping), by basket item
    and by customer; the customer filter and all windows share the
    last. Two more exchanges move the kept skus and the customers."""
    plan = physical(B.basket_rows(path.purchases, False))
    windows = plan.count("Window [")
    exchanges = len(re.findall(r"Exchange hashpartitioning", plan))
    assert windows >= 3 and exchanges == 5, plan
    assert len(re.findall(r"Exchange hashpartitioning\(scope_id#\d+, user_id#\d+, \d+\)", plan)) == 2


def test_scans_read_few_columns_and_push_filters(path):
    plan = formatted(X.scope_facts(path.inputs.lines, path.member, path.p))
    schemas = {m for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan)}
    orders = next(s for s in schemas if "o_orderdate" in s)
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    lines = next(s for s in schemas if "l_partkey" in s)
    assert not any(c in lines for c in ("l_tax", "l_shipdate", "l_returnflag", "l_suppkey", "l_linenumber"))
    assert re.search(r"PushedFilters: \[.*o_orderdate", plan) or "o_orderdate" in re.search(r"DataFilters.*", plan).group(0)
    staged = formatted(path.adjacent)
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(prev_count\)", staged)


def test_one_join_makes_all_pairs(path, unbroadcast):
    """Adjacent and within-basket pairs come from one join on (customer, later basket, kind, blocks); no other join meets baskets."""
    plan = physical(path.measures)
    made = re.findall(r"SortMergeJoin \[scope_id#\d+, user_id#\d+, _at#\d+, _adjacent#\d+, _x#\d+, _y#\d+\]", plan)
    assert len(made) == 1 and "seqnum" not in " ".join(re.findall(r"SortMergeJoin \[[^\]]*\]", plan))
