"""Inputs from tab-separated files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketshift.plans import catalog
from basketshift.plans.order_path import OrderInputs, OrderPath
from basketshift.sources import readers as R
from basketshift.sources.load import BATCH_TABLES, load_batch, load_tsv
from basketshift.sources.star import Star

FOLDER = "/root/testdata/sf0.001"


def test_reasons_and_counts(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tn\td\n1\t2\t2020-01-31\n\t\t\nx\tfour\t2020-01-31\nx\tNULL\tN/A\nNA\t4\t\n1\t2\n1\t2\t3\t4\n")
    (tmp_path / "b.tsv").write_text("id\tn\td\n7\t8\t2020-02-30\n9\t+1\tnan\n")
    found = load_tsv(spark, str(tmp_path), "id string, n int, d date", "t", ["id"])
    assert sorted((r["id"], r["n"], str(r["d"])) for r in found.rows.collect()) == [("1", 2, "2020-01-31"), ("9", 1, "None"), ("x", None, "None")]
    assert sorted((r["source"], r["file"], r["line"], r["reason"]) for r in found.rejects.collect()) == [
        ("t", "a.tsv", "1\t2", "columns: 2"), ("t", "a.tsv", "1\t2\t3\t4", "columns: 4"), ("t", "a.tsv", "NA\t4\t", "missing: id"),
        ("t", "a.tsv", "x\tfour\t2020-01-31", "type: n"), ("t", "b.tsv", "7\t8\t2020-02-30", "type: d")]
    assert {r["file"]: (r["rows"], r["empty"], r["rejected"]) for r in found.counts.collect()} == {"a.tsv": (2, 1, 4), "b.tsv": (1, 0, 1)}


def test_a_batch_loaded_from_files_gives_the_same_result(spark, tmp_path):
    star = Star(spark, FOLDER)
    tables = {"order_lines": star.order_lines(with_category=True), "sku_master": star.sku_master(), "category_tree": star.category_tree(),
              "attributes": star.attributes(), "brand_dict": star.brand_dict(), "fourth_category": star.fourth_category()}
    for name, (spec, _) in BATCH_TABLES.items():
        names = [c.split()[0] for c in spec.split(", ")]
        R.write_tsv(tables[name].select(*[F.col(c).cast("string") for c in names]), str(tmp_path / name), header=True)
    inputs, rejects, counts = load_batch(spark, str(tmp_path))
    assert rejects.count() == 0 and {r["source"] for r in counts.collect()} == set(BATCH_TABLES)
    assert counts.agg(F.sum("rows")).first()[0] == sum(t.count() for t in tables.values())
    direct = catalog.order_path(spark, FOLDER)
    loaded = OrderPath(OrderInputs(inputs.lines, inputs.skus, catalog.scopes(star)), direct.p)
    a, b = (sorted((r["src_item_id"], r["dst_item_id"], round(r["switching_prob"], 9)) for r in p.switching.collect()) for p in (direct, loaded))
    assert a == b and a
    again, rejects, _ = load_batch(spark, str(tmp_path), {"brand_dict": star.brand_dict()})
    assert again.brands.columns == ["brand_id", "brand_name"] and rejects.count() == 0
    with pytest.raises(ValueError, match="lacks columns"):
        load_batch(spark, str(tmp_path), {"brand_dict": star.brand_dict().drop("brand_id")})
