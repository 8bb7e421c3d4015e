"""Scopes, scans, checks and sinks."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from basketshift import session
from basketshift.functions import columns as C
from basketshift.operators import facts as X
from basketshift.operators import publish as K
from basketshift.operators import quality as Q
from basketshift.operators import scope as S
from basketshift.params import Params, resolve_window
from basketshift.sources import readers as R
from basketshift.sources import schemas
from basketshift.sources.schemas import conform

SCOPES = "scope_id string, item_third_cate_cd string, scope_type string, scope_desc string"
SWITCH = schemas.SWITCHING + ", found_in string"


@pytest.mark.parametrize("today,end,start,want", [
    (date(2018, 3, 15), None, None, (date(2018, 2, 28), date(2016, 3, 1))),
    (date(2018, 1, 5), None, None, (date(2017, 12, 31), date(2016, 1, 1))),
    (date(2018, 3, 15), date(2017, 11, 30), None, (date(2017, 11, 30), date(2015, 12, 1))),
    (date(2018, 3, 15), date(2017, 11, 30), date(2017, 1, 1), (date(2017, 11, 30), date(2017, 1, 1))),
    (date(2018, 3, 15), date(2020, 2, 29), None, (date(2020, 2, 29), date(2018, 3, 1))),
])
def test_analysis_window(spark, today, end, start, want):
    assert resolve_window(2, today, end, start) == want[::-1]
    if start is None:
        e = F.lit(end) if end else C.last_day_of_previous_month(F.lit(today))
        assert tuple(spark.range(1).select(e, C.window_start(e, 2)).first()) == want


def test_params_are_checked():
    with pytest.raises(ValueError):
        Params(end_date=date(2020, 1, 1), start_date=date(2019, 1, 1), item_type="shop")
    assert Params(end_date=date(2020, 2, 29), start_date=date(2019, 1, 1)).publish_date == date(2020, 3, 1)


def test_category_lists(spark):
    tree = spark.createDataFrame([("1", "11", "a", "apples"), ("2", "21", "b", "bread")], schemas.CATEGORY_TREE)
    lists = spark.createDataFrame([("b-x-a",), ("a",), ("a",)], "item_third_cate_cd string")
    got = {r["item_third_cate_cd"]: tuple(r) for r in S.category_enrich(lists, tree).collect()}
    assert got == {"b-x-a": ("2-0-1", "21-0-11", "b-x-a", "bread-None-apples"), "a": ("1", "11", "a", "apples")}
    scope = S.scope_table(S.category_enrich(lists.limit(1), tree), "self", "sku", "lvl4").first()
    assert scope["scope_id"] == "2-0-1_21-0-11_b-x-a_self_lvl4_bread-None-apples_sku"
    assert scope["super_scope_id"] == "2-0-1_21-0-11_b-x-a_self_super_bread-None-apples_sku"


def test_membership(spark):
    skus = spark.createDataFrame([("1", "a", "self"), ("2", "a", "pop"), ("3", "a", "other"), ("4", "b", "self")],
                                 "item_sku_id string, cid3 string, sku_type string")
    scopes = spark.createDataFrame([("s", "a-b", "self", "lvl3", ""), ("p", "a", "pop", "lvl3", ""), ("any", "a-a", "both", "lvl3", ""),
                                    ("four", "a-b", "self", "lvl4", "v")], "scope_id string, item_third_cate_cd string, self_pop string, scope_type string, scope_desc string")
    fourth = spark.createDataFrame([("1", "v"), ("4", "w"), ("2", "v")], "sku_id string, attr_value string")
    got = sorted(tuple(r) for r in S.membership(scopes, skus, fourth).select("scope_id", "item_sku_id").collect())
    assert got == [("any", "1"), ("any", "2"), ("four", "1"), ("p", "2"), ("s", "1"), ("s", "4")]


def test_brand_mapping_takes_the_smallest(spark):
    attrs = spark.createDataFrame([("1", 1, "品牌", "x"), ("1", 0, "品牌", "w"), ("1", 2, "品牌", "a"), ("2", 1, "品牌", "y"), ("3", 1, "colour", "w")],
                                  schemas.ATTRIBUTES)
    brands = spark.createDataFrame([("b2", "w"), ("b1", "w"), ("b0", None), (None, "y")], schemas.BRAND_DICT)
    got = {r["item_sku_id"]: (r["item_name"], r["item_id"]) for r in X.brand_map(attrs, brands).collect()}
    assert got == {"1": ("w", "b1"), "2": ("y", None)}
    lines = spark.createDataFrame([("1",), ("2",), ("9",)], "item_sku_id string")
    p = Params(end_date=date(2020, 1, 1), start_date=date(2019, 1, 1), item_type="brand")
    assert {r["item_sku_id"]: r["item_id"] for r in X.with_items(lines, p, X.brand_map(attrs, brands)).collect()} == {"1": "b1", "2": None, "9": None}


def test_tsv(spark, tmp_path):
    f = tmp_path / "t.tsv"
    f.write_text('sku_id\tname\tn\n1\t"quoted\t2\n2\tNULL\tNaN\n\t\t\nNA\tN/A\t\n007\tNone\t3\n', encoding="utf-8")
    df = R.read_tsv(spark, str(f), "sku_id string, name string, n double")
    assert sorted(map(tuple, df.collect())) == [("007", None, 3.0), ("1", '"quoted', 2.0), ("2", None, None)]
    headless = str(tmp_path / "out")
    R.write_tsv(df, headless, header=False)
    assert sorted(map(tuple, R.read_tsv(spark, headless, "a string, b string, c double", header=False).collect())) == sorted(map(tuple, df.collect()))


def test_view_window_leaves_out_the_end(spark):
    rows = [("i", "u", None, "s", "1", date(2024, 1, x)) for x in (19, 20, 30, 31)] + [
        ("i", "u", None, None, "1", date(2024, 1, 25)), ("i", "u", None, "s", "2", date(2024, 1, 25))]
    df = spark.createDataFrame(rows, schemas.CLICK_LOG)
    assert [r["session_id"] for r in R.view_scan(df, date(2024, 1, 31)).collect()] == ["s1", "s1"]


def test_conform(spark):
    df = spark.createDataFrame([(1, "2", "x")], "sku_id int, web_id string, more string")
    with pytest.raises(ValueError):
        conform(df, schemas.ATTRIBUTES)
    assert conform(df, "sku_id string, web_id int").dtypes == [("sku_id", "string"), ("web_id", "int")]


def test_input_check_needs_every_month(spark):
    scopes = spark.createDataFrame([("full", "a", "lvl3", ""), ("gap", "b", "lvl3", ""), ("bare", "c", "lvl3", ""), ("both", "a-b", "lvl3", "")], SCOPES)
    months = [date(2016 + m // 12, m % 12 + 1, 10) for m in range(24)]
    lines = [("a", d) for d in months] + [("b", d) for d in months[:5] + months[6:]] + [("c", d) for d in months]
    df = spark.createDataFrame(lines, "cid3 string, sale_ord_dt date")
    coverage = Q.month_coverage(df, scopes, date(2017, 12, 31))
    assert coverage.count() == 4 * 24
    assert [(r["scope_id"], r["month"]) for r in coverage.where("n_lines = 0").collect()] == [("gap", date(2016, 6, 1))]
    skus = spark.createDataFrame([(c, c) for c in "abc"], "item_sku_id string, cid3 string")
    attrs = spark.createDataFrame([("a", 1, "k", "v"), ("b", 1, "k", "v")], schemas.ATTRIBUTES)
    got = {r["scope_id"]: r["input_check"] for r in Q.input_check(coverage, skus, attrs, scopes).collect()}
    assert got == {"full": 0, "gap": 1, "bare": 1, "both": 0}


def scope_ids(spark, *ids):
    return spark.createDataFrame([(i, "a", "lvl3", "") for i in ids], SCOPES)


def test_switch_check(spark):
    rows = {"good": [.5, .5], "over": [1.1, .1], "under": [-.1, .5], "same": [.02] * 50, "few": [.02] * 49}
    data = [(s, "x", str(i), p, "order", s) for s, ps in rows.items() for i, p in enumerate(ps)] + [("good", "x", "y", .1, "order", "stray")]
    scopes = scope_ids(spark, *rows, "stray", "silent")
    got = {r["scope_id"]: r["switch_check"] for r in Q.switch_check(spark.createDataFrame(data, SWITCH), scopes, "found_in").collect()}
    assert got == {"good": 0, "over": 1, "under": 1, "same": 1, "few": 0, "stray": 1, "silent": 0}


def test_cdt_check_and_status(spark):
    inf = float("-inf")
    rows = {"good": [1.0, .2], "low": [.9], "null": [1.0, None], "inf": [1.0, inf], "only_null": [None], "unfed": [1.0]}
    forest = [(s, str(i), v, "Random Forest Regression") for s, vs in rows.items() for i, v in enumerate(vs)]
    cdt = spark.createDataFrame(forest + [("good", "z", None, "Elastic Net Regression")], schemas.CDT)
    scopes = scope_ids(spark, *rows, "silent")
    checks = Q.cdt_check(cdt, scopes)
    assert {r["scope_id"]: r["cdt_check"] for r in checks.collect()} == {
        "good": 0, "low": 1, "null": 1, "inf": 1, "only_null": 1, "unfed": 0, "silent": 0}
    ids = scopes.select("scope_id")
    inputs = ids.withColumn("input_check", F.when(F.col("scope_id") == "unfed", 1).otherwise(0))
    numbers, switches = ids.withColumn("sku_number", F.lit(7)), ids.withColumn("switch_check", F.lit(0))
    got = {r["scope_id"]: tuple(r)[1:] for r in Q.status_table(inputs, numbers, switches, checks).collect()}
    assert got["good"] == ("0", "7", "0", "0", "0") and got["low"] == ("0", "7", "0", "1", "1")
    assert got["unfed"] == ("1", "-1", "1", "1", "1")


def test_gate(spark):
    checks = spark.createDataFrame([("a", 0), ("b", 1)], "scope_id string, switch_check int")
    results = spark.createDataFrame([("a",), ("b",)], "scope_id string")
    assert [r[0] for r in Q.publish_gate(results, checks, "switch_check").collect()] == ["a"]
    assert Q.publish_gate(results, checks, "switch_check", whole_batch=True).count() == 0
    assert Q.publish_gate(results, checks.where("scope_id = 'a'"), "switch_check", whole_batch=True).count() == 2


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    tmp, pre, final = (str(tmp_path / n) for n in ("tmp", "pre", "final"))

    def rows(*items):
        return spark.createDataFrame([(f"1_2_{c}_x", "i", "j", p, "order") for c, p in items], schemas.SWITCHING)

    K.publish(K.with_partition(rows(("a", .1), ("b", .2)), date(2020, 1, 1)), tmp, pre, final, schemas.SWITCHING)
    out = K.publish(K.with_partition(rows(("b", .3)), date(2020, 1, 1)), tmp, pre, final, schemas.SWITCHING)
    assert [(r["cid3"], r["switching_prob"]) for r in out.collect()] == [("b", .3)]
    for path in (pre, final):
        got = {(r["dt"], r["cid3"]): r["switching_prob"] for r in K.read_partitions(spark, path, schemas.SWITCHING).collect()}
        assert got == {("2020-01-01", "a"): .1, ("2020-01-01", "b"): .3}


def test_assemble_and_status(spark, tmp_path):
    sw = [spark.createDataFrame([(f"1_2_{c}_x", "i", "j", .5, "order")], schemas.SWITCHING) for c in "ab"]
    sc = [spark.createDataFrame([("1_2_a_x", "1", "2", "a", "self", "lvl3", "d", "sku")], schemas.SCOPE)]
    cdt = [spark.createDataFrame([("1_2_a_x", "价格", 1.0, "m")], schemas.CDT)]
    loaded = K.assemble({"switching_prob": sw, "scope": sc, "cdt_cn": cdt, "cdt": sw}, date(2020, 1, 1), str(tmp_path))
    assert loaded == ["scope", "switching_prob", "cdt"]
    assert K.read_partitions(spark, str(tmp_path / "switching_prob"), schemas.SWITCHING, cid3=["b"]).count() == 1
    assert K.read_partitions(spark, str(tmp_path / "cdt"), schemas.CDT).first()["attdesc"] == "价格"
    assert K.read_partitions(spark, str(tmp_path / "scope"), schemas.SCOPE, dt="2020-01-01").first()["id"] == "1_2_a_x"
    status = spark.createDataFrame([("1_2_a_x", "0", "3", "0", "0", "0")], schemas.STATUS)
    K.publish_status(K.with_partition(status, date(2020, 1, 1)), str(tmp_path / "st"), str(tmp_path / "sf"), schemas.STATUS)
    assert K.read_partitions(spark, str(tmp_path / "sf"), schemas.STATUS).first()["sku_number"] == "3"


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    class Fake:
        master = "yarn"
        shared = None

        def get(self, key, default=None):
            return self.shared

        def getConf(self):
            return self

        conf = sparkContext = property(lambda self: self)

    cluster = Fake()
    with pytest.raises(RuntimeError):
        session.staging_root(cluster)
    cluster.shared = "hdfs:///shared/"
    assert session.staging_root(cluster) == "hdfs:///shared"
    monkeypatch.setattr(Fake, "master", "local[2]")
    monkeypatch.setattr(Fake, "shared", None)
    del cluster.shared
    assert "basketshift-" in session.staging_root(cluster)


def test_staged_tables_can_be_dropped(spark):
    df = session.stage(spark.range(5), "probe")
    assert df.count() == 5
    path = df.inputFiles()[0]
    session.drop_staged(spark)
    import os
    assert not os.path.exists(path.replace("file://", ""))
