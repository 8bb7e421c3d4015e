"""Attribute similarities, importances and their naming."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketshift.operators import attributes as A
from basketshift.operators import importance as M

PAIRS = "scope_id string, src_item_id string, dst_item_id string, switching_prob double"
TEXT = "scope_id string, attr_key string, item_id string, attr_val string"
NUMBER = "scope_id string, attr_key string, item_id string, attr_val double"
EXAMPLE = [("A", "B"), ("A", "C"), ("B", "A"), ("B", "C"), ("C", "B")]


def pairs(spark, rows=EXAMPLE, scope="s"):
    return spark.createDataFrame([(scope, a, b, 0.5) for a, b in rows], PAIRS)


def sims(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["attr_key"], {})[r["src_item_id"] + r["dst_item_id"]] = r["similarity"]
    return out


def test_categorical_example(spark):
    attrs = spark.createDataFrame([("s", "colour", "A", "red"), ("s", "colour", "B", "red"), ("s", "shape", "C", "round")], TEXT)
    got = sims(A.attr_categorical(pairs(spark), attrs))
    assert got["colour"] == {"AB": 1, "BA": 1, "AC": 0, "BC": 0, "CB": 0}
    assert got["shape"] == {"AB": 1, "BA": 1, "AC": 0, "BC": 0, "CB": 0}


def test_categorical_explicit_null_gets_the_mean(spark):
    """C has the attribute without a value; the mean counts such pairs as 0."""
    attrs = spark.createDataFrame([("s", "k", "A", "x"), ("s", "k", "B", "x"), ("s", "k", "C", None)], TEXT)
    assert sims(A.attr_categorical(pairs(spark), attrs))["k"] == pytest.approx({"AB": 1, "BA": 1, "AC": .4, "BC": .4, "CB": .4})


def test_numeric_example(spark):
    attrs = spark.createDataFrame([("s", "volume", "A", 1.0), ("s", "volume", "B", 3.0), ("s", "volume", "C", 15.0),
                                   ("s", "weight", "A", 1.0), ("s", "weight", "B", 3.0)], NUMBER)
    got = sims(A.attr_numeric(pairs(spark), attrs))
    assert got["volume"] == pytest.approx({"AB": 2 / 3, "BA": 2 / 3, "AC": 0, "BC": 1 / 3, "CB": 1 / 3})
    assert got["weight"] == pytest.approx(dict.fromkeys(["AB", "BA", "AC", "BC", "CB"], 0))


def test_numeric_edges(spark):
    attrs = spark.createDataFrame(
        [("s", "same", i, 5.0) for i in "ABC"] + [("s", "below", "A", -2.0), ("s", "below", "B", 1.0), ("s", "below", "C", 3.0)]
        + [("s", "lonely", "A", 1.0)], NUMBER)
    got = sims(A.attr_numeric(pairs(spark), attrs))
    assert set(got["same"].values()) == {1.0}
    assert got["below"] == {"AB": 0, "BA": 0, "AC": 0, "BC": 0, "CB": 0}
    assert set(got["lonely"].values()) == {None}


def test_collapse_takes_the_largest(spark):
    attrs = spark.createDataFrame([("s", "k", "A", "x"), ("s", "k", "A", "y"), ("s", "k", "A", None), ("s", "k", "B", None)], TEXT)
    assert {r["item_id"]: r["attr_val"] for r in A.attr_collapse(attrs).collect()} == {"A": "y", "B": None}


def test_split(spark):
    attrs = spark.createDataFrame([("s", "n", "A", "1.5"), ("s", "n", "B", None), ("s", "m", "A", "1"), ("s", "m", "B", "one"),
                                   ("t", "m", "A", "2"), ("s", "e", "A", None)], TEXT)
    cat, num = A.attr_split(attrs)
    assert {(r["scope_id"], r["attr_key"]) for r in cat.collect()} == {("s", "m"), ("s", "e")}
    assert {(r["scope_id"], r["attr_key"], r["attr_val"]) for r in num.collect()} == {("s", "n", 1.5), ("s", "n", None), ("t", "m", 2.0)}


def test_filters(spark):
    attrs = spark.createDataFrame([(s, k, "A", "v") for s in ("three", "four") for k in ("noun", "colour", "size")], TEXT)
    scopes = spark.createDataFrame([("three", "lvl3"), ("four", "lvl4")], "scope_id string, scope_type string")
    ignored = spark.createDataFrame([("three", "size"), ("other", "colour")], "scope_id string, ignored_attr string")
    got = A.attr_filter(attrs, scopes, "noun", ignored, exclude=["nothing"])
    assert {(r["scope_id"], r["attr_key"]) for r in got.collect()} == {
        ("three", "noun"), ("three", "colour"), ("four", "colour"), ("four", "size")}


def test_dedupe_and_translate(spark):
    keys = spark.createDataFrame([("a", ["price", "价格", "volume", "总容量", "总重量", "colour"]), ("b", ["price", "价格ish", "unit", "包装件数"])],
                                 "scope_id string, keys array<string>")
    out = A.attr_dedupe(keys)
    got = {r["scope_id"]: (sorted(r["keys"]), r["names"]) for r in out.collect()}
    assert got["a"] == (["colour", "price", "volume"], {"price": "价格", "volume": "总重量"})
    assert got["b"] == (["unit", "价格ish"], {"unit": "包装件数"})
    cdt = spark.createDataFrame([("a", "volume", 1.0, "m"), ("a", "colour", .5, "m"), ("b", "volume", 1.0, "m")],
                                "scope_id string, attdesc string, Estimate double, SimulationType string")
    shown = {(r["scope_id"], r["attdesc"]) for r in M.cdt_translate(cdt, out).collect()}
    assert shown == {("a", "总重量"), ("a", "colour"), ("b", "总容量/总重量")}
    assert {r["attdesc"] for r in M.cdt_translate(cdt).collect()} == {"总容量/总重量", "colour"}


def test_pair_base_keeps_shares(spark):
    df = spark.createDataFrame([("s", "A", "A", .6, "order"), ("s", "A", "B", .4, "order"), ("s", "A", "C", .0, "order")],
                               "scope_id string, src_item_id string, dst_item_id string, switching_prob double, model string")
    assert [tuple(r) for r in A.pair_base(df).collect()] == [("s", "A", "B", .4)]


def test_pair_sales(spark):
    lines = spark.createDataFrame([("A", 100.25), ("A", 89.75), ("B", 110.0)], "item_sku_id string, after_prefr_amount double")
    rows = A.pair_sales(pairs(spark), A.item_net_sales(lines)).collect()
    got = {r["src_item_id"] + r["dst_item_id"] + e: r[e] for r in rows for e in ("fromSales", "toSales")}
    # C has no sales: the mean over the pair rows that do.
    frm, to = (190 + 190 + 110 + 110) / 4, (110 + 190 + 110) / 3
    want = {"AB": (190, 110), "AC": (190, to), "BA": (110, 190), "BC": (110, to), "CB": (frm, 110)}
    assert got == pytest.approx({k + e: v for k, vs in want.items() for e, v in zip(("fromSales", "toSales"), vs)})


def test_sales_of_brands(spark):
    lines = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 4.0)], "item_sku_id string, after_prefr_amount double")
    brand = spark.createDataFrame([("A", "b1"), ("B", "b1"), ("C", None)], "item_sku_id string, item_id string")
    assert {r["item_id"]: r["sales"] for r in A.item_net_sales(lines, brand).collect()} == {"b1": 3.0}


MAPS = "scope_id string, src_item_id string, dst_item_id string, switching_prob double, fromSales double, toSales double, sims map<string,double>"


@pytest.mark.parametrize("fit,name", [(M.cdt_rf, M.FOREST), (M.cdt_enet, M.ELASTIC_NET)])
def test_importances(spark, fit, name):
    """The label depends on x alone in one scope, on z alone in the other; y is noise, w is
    absent from both."""
    base = spark.range(400).select(F.col("id").cast("string").alias("src_item_id"), F.lit("d").alias("dst_item_id"),
                                   F.rand(1).alias("x"), F.rand(2).alias("y"), F.rand(3).alias("z"))
    sims = F.create_map(*[x for c in "xyz" for x in (F.lit(c), F.col(c))], F.lit("w"), F.lit(None).cast("double"))
    parts = [base.select(F.lit(s).alias("scope_id"), "src_item_id", "dst_item_id", (F.col(c) * 0.5).alias("switching_prob"),
                         F.lit(1.0).alias("fromSales"), F.rand(4).alias("toSales"), sims.alias("sims")) for s, c in (("a", "x"), ("b", "z"))]
    out = fit(parts[0].unionByName(parts[1])).collect()
    est = {(r["scope_id"], r["attdesc"]): r["Estimate"] for r in out}
    assert {r["SimulationType"] for r in out} == {name}
    assert set(est) == {(s, c) for s in "ab" for c in ("x", "y", "z", "fromSales", "toSales")}
    assert est["a", "x"] == 1.0 and est["b", "z"] == 1.0
    assert all(0 <= v < 0.3 for k, v in est.items() if k not in (("a", "x"), ("b", "z")))


def test_a_scope_without_usable_rows_does_not_stop_the_others(spark):
    from basketshift.operators.importance import cdt_rf

    rows = [("good", f"s{i}", f"d{i}", i % 5 / 5.0, float(i), 2.0, {"k": float(i % 5)}) for i in range(30)]
    rows += [("single", "a", "b", 0.5, 1.0, 1.0, {"k": 1.0}), ("no sales", "a", "b", 0.5, None, None, {"k": 1.0}),
             ("no sales", "b", "a", 0.1, None, None, {"k": 0.0}), ("empty", "a", "b", 0.5, None, None, {"k": None})]
    maps = spark.createDataFrame(rows, "scope_id string, src_item_id string, dst_item_id string, switching_prob double, fromSales double, toSales double, sims map<string,double>")
    got = {}
    for r in cdt_rf(maps).collect():
        got.setdefault(r["scope_id"], {})[r["attdesc"]] = r["Estimate"]
    assert set(got) == {"good", "no sales"} and set(got["good"]) == {"k", "fromSales", "toSales"} and set(got["no sales"]) == {"k"}


def test_only_plain_finite_numbers_count(spark):
    from basketshift.functions import columns as C

    texts = ["1", "-2.5", "+3.", ".5", "1e3", "1e999", "NaN", "Infinity", "5d", "0x10", "", " 1", "1 2", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.number("t")).collect()]
    assert got == [1.0, -2.5, 3.0, 0.5, 1000.0] + [None] * 9
    nan = spark.range(1).select(C.log_distance(F_lit("nan"), F_lit("1")), C.log_distance(F_lit("inf"), F_lit("1")), C.log_distance(F_lit("3"), F_lit("1"))).first()
    assert nan[0] is None and nan[1] is None and nan[2] == 1.0


def F_lit(text):
    from pyspark.sql import functions as F

    return F.lit(float(text))


def test_failing_fits_are_not_scopes_without_rows(spark, monkeypatch):
    from basketshift.operators import forest
    from basketshift.operators import quality as Q

    rows = [(s, f"s{i}", f"d{i}", i % 5 / 5.0, 1.0, 2.0, {"k": float(i % 5)}) for s, n in (("good", 30), ("single", 1)) for i in range(n)]
    maps = spark.createDataFrame(rows, MAPS)
    found = M.cdt_rf(maps)
    assert {r["scope_id"]: r["cdt_check"] for r in Q.cdt_check(found, maps.select("scope_id").distinct()).collect()} == {"good": 0, "single": 0}

    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(forest, "histograms", lost)
    failed = []
    found = M.cdt_rf(maps, failed=failed)
    assert sorted(failed) == ["good", "single"] and found.count() == 0
    assert {r["cdt_check"] for r in Q.cdt_check(found, maps.select("scope_id").distinct(), failed=failed).collect()} == {-1}
    with pytest.raises(RuntimeError):
        M.cdt_rf(maps)
