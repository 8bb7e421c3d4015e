"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from basketshift.plans import catalog
from tests.compare import database, differences

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = entry.oracle_sql()


def test_statements_belong_to_queries():
    assert set(catalog.all_queries()) <= set(STATEMENTS)
    assert set(STATEMENTS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), database(FOLDER), STATEMENTS[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["scope_id", "src_item_id", "dst_item_id", "switching_prob", "model"] and df.count() > 0


def test_importances_keep_their_contract(spark):
    rows = entry.queries()["cdt_rf"](spark, FOLDER).collect()
    tops = {}
    for r in rows:
        assert r["Estimate"] is not None and 0 <= r["Estimate"] <= 1
        tops[r["scope_id"]] = max(tops.get(r["scope_id"], 0), r["Estimate"])
    assert len(tops) == 6 and set(tops.values()) == {1.0}
