"""The whole batch on the smallest tables, and the watcher that starts it."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from basketshift.operators import publish as K
from basketshift.params import Params
from basketshift.plans.batch import Batch, BatchInputs, BatchOptions
from basketshift.sources import readers as R
from basketshift.sources import schemas
from basketshift.sources.star import Star
from basketshift.streaming.control import watch

FOLDER = "/root/testdata/sf0.001"
SPEND = "item_id string, from_item_id string, spendswitch double, cr double, ci double, switch_prob double, scope_id string"


def inputs(spark):
    star = Star(spark, FOLDER)
    return BatchInputs(star.order_lines(with_category=True), R.sku_scan(star.sku_master()), star.category_tree(), star.attributes(),
                       star.brand_dict(), star.fourth_category(), star.click_log())


def control(spark, path, *rows):
    K.overwrite_partitions(spark.createDataFrame(list(rows), schemas.CONTROL), path)


def flags(spark, path):
    return {(r["dt"], r["cid3"]): r["status"] for r in K.read_partitions(spark, path, "status string").collect()}


def test_order_batch(spark, tmp_path):
    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    control(spark, ctl, ("0", "2001-07-31", "ECONOMY"), ("0", "2001-07-31", "PROMO"), ("1", "2001-06-30", "SMALL"), ("0", "2001-07-31", "GHOST"))
    p = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    status = {r["scope_id"]: tuple(r)[1:] for r in Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run().collect()}
    economy = "1_11_ECONOMY_self_lvl3_economy_sku"
    assert status[economy][0] == "0" and status[economy][2:] == ("0", "0", "0")
    assert status["0_0_GHOST_self_lvl3_None_sku"] == ("1", "-1", "1", "1", "1")
    published = K.read_partitions(spark, f"{root}/switching_prob", schemas.SWITCHING, dt="2001-08-01")
    assert {r["cid3"] for r in published.select("cid3").distinct().collect()} == {"ECONOMY", "PROMO"}
    cdt = K.read_partitions(spark, f"{root}/cdt", schemas.CDT).where(f"scope_id = '{economy}'").collect()
    assert max(r["Estimate"] for r in cdt) == 1.0 and {"colour", "品牌", "fromSales", "toSales"} <= {r["attdesc"] for r in cdt}
    assert K.read_partitions(spark, f"{root}/status", schemas.STATUS).count() == 3
    assert K.read_partitions(spark, f"{root}/sku_in_scope", schemas.SKU_IN_SCOPE, dt="2001-07-31").count() > 0
    assert set(flags(spark, ctl).values()) == {"1"}
    assert Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run() is None


def test_each_day_is_computed_for_itself(spark, tmp_path):
    """Two pending days: each gets the window that ends on it, and the same result as in a batch of its own."""
    ctl, root, alone = (str(tmp_path / n) for n in ("control", "out", "alone"))
    p = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    control(spark, ctl, ("0", "2001-07-31", "ECONOMY"), ("0", "2000-06-30", "PROMO"))
    assert Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run().count() == 2
    assert set(flags(spark, ctl).values()) == {"1"}
    published = K.read_partitions(spark, f"{root}/switching_prob", schemas.SWITCHING)
    days = {(r["dt"], r["cid3"]) for r in published.select("dt", "cid3").distinct().collect()}
    assert days == {("2001-08-01", "ECONOMY"), ("2000-07-01", "PROMO")}
    early = Params(end_date=date(2000, 6, 30), start_date=date(1994, 7, 1), prod_tail=0.95)
    control(spark, ctl + "2", ("0", "2000-06-30", "PROMO"))
    Batch(spark, ctl + "2", alone, inputs(spark), early, BatchOptions()).run()
    rows = lambda r: sorted(map(tuple, K.read_partitions(spark, f"{r}/switching_prob", schemas.SWITCHING).where("cid3 = 'PROMO'").collect()))
    assert rows(root) == rows(alone) and rows(root)
    raw = K.read_partitions(spark, f"{root}/cdt_raw", schemas.CDT)
    assert {"colour", "fromSales"} <= {r["attdesc"] for r in raw.select("attdesc").distinct().collect()}


def test_watched_log_batch_of_sub_scopes(spark, tmp_path):
    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    control(spark, ctl, ("0", "2024-01-31", "ECONOMY-LARGE-SMALL"), ("1", "2024-01-30", "PROMO"))
    p = Params(end_date=date(2024, 1, 31), start_date=date(1995, 1, 1))
    o = BatchOptions(scope_type="lvl4", classify_attr="noun", source="log", codes=("view", "click", "purchase", "signup"))
    seen = []

    def handle(pending):
        seen.append(sorted(r["cid3"] for r in pending.collect()))
        Batch(spark, ctl, root, inputs(spark), p, o).run(pending)

    q = watch(spark, ctl, handle, every=None, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None and seen == [["ECONOMY-LARGE-SMALL"]]
    status = K.read_partitions(spark, f"{root}/status", schemas.STATUS).collect()
    assert len(status) > 3 and all("_lvl4_" in r["scope_id"] for r in status)
    # The order tables end in 2001, so the month check of these scopes fails and nothing is published.
    assert {r["input_check"] for r in status} == {"1"}
    assert flags(spark, ctl)["2024-01-31", "ECONOMY-LARGE-SMALL"] == "1"


@pytest.mark.parametrize("ext", [True])
def test_extended_attributes(spark, ext):
    from basketshift.plans.batch import extended_as_attributes

    df = spark.createDataFrame([(1, "7", "colour", "red", "c", "d")], schemas.EXTENDED_ATTRIBUTES)
    assert tuple(extended_as_attributes(df).first()) == ("7", 1, "colour", "red")


def test_a_failed_fit_keeps_importances_and_stays_pending(spark, tmp_path, monkeypatch):
    from basketshift.operators import importance as M

    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    p = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    rows = lambda name: sorted(map(tuple, K.read_partitions(spark, f"{root}/{name}", schemas.CDT).where("cid3 = 'ECONOMY'").collect()))
    pending = (("0", "2001-07-31", "ECONOMY"), ("0", "2001-07-31", "PROMO"))
    control(spark, ctl, *pending)
    Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run()
    first = {n: rows(n) for n in ("cdt", "cdt_raw")}
    control(spark, ctl, *pending)
    whole = M.cdt_rf
    economy = "1_11_ECONOMY_self_lvl3_economy_sku"

    def broken(maps, seed=7, failed=None):
        failed.append(economy)
        return whole(maps.where(f"scope_id <> '{economy}'"), seed, failed)

    monkeypatch.setattr(M, "cdt_rf", broken)
    status = {r["scope_id"]: r for r in Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run().collect()}
    assert status[economy]["cdt_check"] == "-1" and status[economy]["status"] == "1" and sorted(r["status"] for r in status.values()) == ["0", "1"]
    assert flags(spark, ctl) == {("2001-07-31", "ECONOMY"): "0", ("2001-07-31", "PROMO"): "1"}
    assert all(first.values()) and {n: rows(n) for n in first} == first


def test_categories_with_parameters_of_their_own(spark, tmp_path):
    """One batch over categories that differ in window, thresholds, item type and source equals a batch of each alone."""
    day, end = "2001-07-31", date(2001, 7, 31)
    own = [("ECONOMY", 36, 0.8, 2, "sku", "ord", None), ("PROMO", None, None, None, "brand", None, True), ("LARGE", 72, None, 1, None, "ord", None)]
    table = spark.createDataFrame(own, "cid3 string, window_months int, prod_tail double, min_baskets int, item_type string, source string, basket_by_day boolean")
    defaults = Params(end_date=end, start_date=date(1995, 8, 1), prod_tail=0.95)
    singles = {"ECONOMY": replace(defaults, start_date=date(1998, 8, 1), prod_tail=0.8, min_baskets=2), "SMALL": defaults,
               "PROMO": replace(defaults, item_type="brand", basket_by_day=True), "LARGE": defaults}
    found = {}
    for name, p, cats, params in [("all", defaults, list(singles), table), *[(c, p, [c], None) for c, p in singles.items()]]:
        ctl, root = str(tmp_path / f"control-{name}"), str(tmp_path / f"out-{name}")
        control(spark, ctl, *[("0", day, c) for c in cats])
        Batch(spark, ctl, root, replace(inputs(spark), params=params), p, BatchOptions()).run()
        for t, schema in (("switching_prob", schemas.SWITCHING), ("sku_in_scope", schemas.SKU_IN_SCOPE), ("spendswitch", SPEND)):
            for r in K.read_partitions(spark, f"{root}/{t}", schema).collect():
                found.setdefault((name == "all", t), set()).add(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    for t in ("switching_prob", "sku_in_scope", "spendswitch"):
        assert found[True, t] == found[False, t] and len({r[-1] for r in found[True, t]}) == 4, t


def test_scopes_of_orders_and_clicks_in_one_batch(spark, tmp_path):
    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    control(spark, ctl, ("0", "2024-01-31", "ECONOMY-LARGE-SMALL"), ("0", "2024-01-31", "PROMO"))
    table = spark.createDataFrame([("ECONOMY-LARGE-SMALL", "log"), ("PROMO", "ord")], "cid3 string, source string")
    p = Params(end_date=date(2024, 1, 31), start_date=date(1995, 1, 1))
    batch = Batch(spark, ctl, root, replace(inputs(spark), params=table), p, BatchOptions(codes=("view", "click", "purchase", "signup")))
    paths = batch._paths(batch.scopes(K.read_partitions(spark, ctl, "status string")))
    assert {r["model"] for r in paths.switching.select("model").distinct().collect()} == {"log", "order"}
    assert {r["cid3"]: r["status"] for r in K.read_partitions(spark, ctl, "status string").collect()} == {"ECONOMY-LARGE-SMALL": "0", "PROMO": "0"}


def test_a_batch_that_is_stopped_leaves_old_or_new_results(spark, tmp_path, monkeypatch):
    """Stopped before each of its renames in turn, a batch leaves every table whole: as it was, or as it is to be."""
    from basketshift.operators.publish import Files

    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    day = "2001-07-31"
    first = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    second = replace(first, prod_tail=0.7)
    tables = {"switching_prob": schemas.SWITCHING, "switching_prob_pre": schemas.SWITCHING, "sku_in_scope": schemas.SKU_IN_SCOPE, "status": schemas.STATUS}

    def seen():
        return {t: frozenset(map(tuple, K.read_partitions(spark, f"{root}/{t}", s).collect())) for t, s in tables.items()}

    control(spark, ctl, ("0", day, "ECONOMY"))
    Batch(spark, ctl, root, inputs(spark), first, BatchOptions()).run()
    old = seen()
    whole, left = Files.create, []

    def stopped(self, name, text):
        if not left:
            raise KeyboardInterrupt
        left.pop()
        return whole(self, name, text)

    monkeypatch.setattr(Files, "create", stopped)
    ready = {t: K.prepare(K.with_partition(K.read_partitions(spark, f"{root}/{t}", s).drop("dt", "cid3").limit(1), "2001-08-01"), [f"{root}/{t}_x", f"{root}/{t}"])
             for t, s in tables.items() if t != "switching_prob_pre"}
    for steps in range(len(ready) * 2):
        left.extend([1] * steps)
        with pytest.raises(KeyboardInterrupt):
            K.commit(spark, *ready.values())
        left.clear()
        now = seen()
        assert all(now[t] == old[t] or len(now[t]) in (1, len(old[t]) + 1) for t in now) and all(now.values())
    assert flags(spark, ctl)[day, "ECONOMY"] == "1"
    monkeypatch.setattr(Files, "create", whole)
    control(spark, ctl, ("0", day, "ECONOMY"))
    Batch(spark, ctl, root, inputs(spark), second, BatchOptions()).run()
    new = seen()
    assert new["switching_prob"] != old["switching_prob"] and new["switching_prob"] == new["switching_prob_pre"]


def test_nothing_staged_is_left_after_a_batch(spark, tmp_path):
    from pathlib import Path

    from basketshift import session

    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    staged = Path(session.staging_root(spark))

    def files():
        return {p for p in staged.rglob("*") if p.is_file()}

    before = files()
    control(spark, ctl, ("0", "2001-07-31", "ECONOMY"))
    p = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    status = Batch(spark, ctl, root, inputs(spark), p, BatchOptions()).run()
    assert not files() - before and [r["status"] for r in status.collect()] == ["0"]
    # Of a table shown three times, one copy is kept for each of the last two manifests.
    assert len(list((Path(root) / "switching_prob" / "_versions").iterdir())) == 1


def test_unreadable_inputs_are_coded(spark, tmp_path):
    ctl, root = str(tmp_path / "control"), str(tmp_path / "out")
    (tmp_path / "gone").mkdir()
    control(spark, ctl, ("0", "2001-07-31", "ECONOMY"))
    p = Params(end_date=date(2001, 7, 31), start_date=date(1995, 8, 1), prod_tail=0.95)
    good = inputs(spark)
    good.attributes.limit(50).write.parquet(str(tmp_path / "attrs"))
    lost = spark.read.parquet(str(tmp_path / "attrs"))
    for f in (tmp_path / "attrs").glob("part*"):
        f.write_bytes(b"not parquet")
    for f in (tmp_path / "attrs").glob(".part*"):
        f.unlink()
    status = Batch(spark, ctl, root, replace(good, attributes=lost), p, BatchOptions()).run().collect()
    assert [tuple(r)[1:] for r in status] == [("-1", "-1", "1", "1", "1")]
    assert flags(spark, ctl)["2001-07-31", "ECONOMY"] == "0"
