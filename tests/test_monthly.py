"""State by month against counts over the lines themselves."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest

from basketshift.operators import distinct as D
from basketshift.operators import publish as K
from basketshift.plans import monthly
from basketshift.plans.monthly import MonthlyState, split_window

SCHEMA = ("user_id string, parent_sale_ord_id string, item_sku_id string, sale_ord_tm timestamp, sale_ord_dt date, sale_ord_valid_flag int, "
          "sale_qtty double, before_prefr_amount decimal(18,2), after_prefr_amount decimal(18,4), cid3 string")
SCOPE = {f"s{i}": f"x_{i % 3}" for i in range(12)}


def some_lines(seed: int, n: int, first: date, days: int) -> list[tuple]:
    """Orders of few lines, some of them over two days and so over two months; some ids are null, some lines not valid."""
    rng, out = random.Random(seed), []
    for i in range(n):
        day = first + timedelta(days=rng.randrange(days))
        order, user = f"o{seed}-{rng.randrange(n // 2)}", rng.choice([None, *(f"u{k}" for k in range(9))])
        sku = rng.choice([*SCOPE, "elsewhere"])
        out.append((user, None if i % 17 == 0 else order, sku, datetime(day.year, day.month, day.day), day, int(i % 11 != 0),
                    float(rng.randrange(1, 5)), None, None, f"c{int(sku[1:]) % 2}" if sku in SCOPE else None))
    return out


def add(spark, folder: str, lines: list[tuple]) -> None:
    df = spark.createDataFrame(lines, SCHEMA)
    df.selectExpr("*", "date_format(sale_ord_dt, 'yyyy-MM') as month").coalesce(1).write.mode("append").partitionBy("month").parquet(folder)


def plain(lines: list[tuple], start: date, end: date):
    """Counts per (scope, kind), orders per customer, quantity per (scope, sku, day)."""
    sets, buyers, daily = defaultdict(set), defaultdict(set), Counter()
    for user, order, sku, _, day, valid, qty, *_ in lines:
        if not (valid and start <= day <= end and sku in SCOPE):
            continue
        for kind, value in (("orders", order), ("skus", sku), ("customers", user)):
            if value is not None:
                sets[SCOPE[sku], kind].add(value)
        if order is not None:
            buyers[SCOPE[sku], user].add(order)
        daily[SCOPE[sku], sku, day] += int(qty * 10_000)
    return {k: len(v) for k, v in sets.items()}, {k: len(v) for k, v in buyers.items()}, dict(daily)


def kept(state: MonthlyState, start: date, end: date):
    return ({(r.scope_id, r.kind): r.n for r in state.scope_counts(start, end).collect()},
            {(r.scope_id, r.user_id): r.ord_qtty for r in state.customer_orders(start, end).collect()},
            {(r.scope_id, r.item_sku_id, r.sale_ord_dt): r.qty for r in state.daily(start, end).collect()})


def member(spark, scopes=SCOPE):
    return spark.createDataFrame([(s, k) for k, s in scopes.items()], "scope_id string, item_sku_id string")


WINDOWS = [(date(2024, 1, 1), date(2024, 4, 30)), (date(2024, 1, 20), date(2024, 3, 10)), (date(2024, 2, 1), date(2024, 2, 29)),
           (date(2024, 2, 3), date(2024, 2, 9)), (date(2023, 1, 1), date(2023, 2, 2))]


def test_windows_are_cut_into_months_and_edges():
    assert split_window(*WINDOWS[1]) == (["2024-02"], [(date(2024, 1, 20), date(2024, 1, 31)), (date(2024, 3, 1), date(2024, 3, 10))])
    assert split_window(*WINDOWS[3]) == ([], [WINDOWS[3]])
    assert split_window(date(2023, 12, 1), date(2024, 1, 31)) == (["2023-12", "2024-01"], [])
    assert split_window(date(2024, 2, 2), date(2024, 2, 1)) == ([], [])


def test_numbers_are_dense_and_stay(spark):
    none = spark.createDataFrame([], D.NUMBERED)
    first = D.number_new(none, spark.createDataFrame([(f"v{i % 700}",) for i in range(2000)] + [(None,)], "value string"))
    got = {r.value: r.number for r in first.collect()}
    assert sorted(got.values()) == list(range(1, 701))
    more = D.number_new(first, spark.createDataFrame([("v1",), ("new",), ("newer",), (None,)], "value string"))
    assert {r.value: r.number for r in more.collect()} == {"new": 701, "newer": 702}
    assert D.number_new(first, first.where("false")).count() == 0


def test_bitmaps_merge_over_buckets(spark):
    rng = random.Random(4)
    rows = [(f"g{rng.randrange(3)}", rng.randrange(4), rng.randrange(1, 100_000)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "g string, month int, number bigint")
    got = {r.g: r.n for r in D.merged_count(D.bitmaps(df, ["g", "month"]), ["g"], "n").collect()}
    assert got == {g: len({n for h, _, n in rows if h == g}) for g in ("g0", "g1", "g2")}


def test_only_changed_months_are_read(spark, tmp_path, monkeypatch):
    extracts, root = str(tmp_path / "extracts"), str(tmp_path / "state")
    (tmp_path / "extracts").mkdir()
    state = MonthlyState(spark, root, extracts, SCHEMA, member(spark))
    assert not state.update().files and kept(state, *WINDOWS[0]) == ({}, {}, {})

    lines = some_lines(1, 900, date(2024, 1, 1), 110)
    add(spark, extracts, lines)
    changes = state.update()
    assert changes.months == ["2024-01", "2024-02", "2024-03", "2024-04"] and len(changes.files) == 4
    for w in WINDOWS:
        assert kept(state, *w) == plain(lines, *w)
    assert not state.update().files

    # Late lines of one month, and a new month: two months are read, the first one's two files included.
    more = some_lines(1, 200, date(2024, 2, 1), 29) + some_lines(2, 100, date(2024, 5, 1), 31)
    add(spark, extracts, more)
    create = K.Files.create
    with monkeypatch.context() as m:
        m.setattr(K.Files, "create", lambda self, name, text: 1 / 0 if name.startswith("seen/") else create(self, name, text))
        with pytest.raises(ZeroDivisionError):
            state.update()
    # More orders come before the stopped update is repeated.
    last = some_lines(4, 100, date(2024, 5, 1), 31)
    add(spark, extracts, last)
    more += last
    changes = state.update()
    assert changes.months == ["2024-02", "2024-05"] and len(changes.files) == 4
    for w in [*WINDOWS[:2], (date(2024, 1, 5), date(2024, 5, 31))]:
        assert kept(state, *w) == plain(lines + more, *w)


def test_months_that_go_and_members_that_change(spark, tmp_path):
    extracts, root = str(tmp_path / "extracts"), str(tmp_path / "state")
    lines = some_lines(3, 300, date(2024, 1, 1), 60)
    add(spark, extracts, lines)
    MonthlyState(spark, root, extracts, SCHEMA, member(spark)).update()
    (tmp_path / "extracts" / "month=2024-01").rename(tmp_path / "month=2024-01")
    state = MonthlyState(spark, root, extracts, SCHEMA, member(spark))
    changes = state.update()
    assert changes.gone == ["2024-01"] and not changes.files
    left = [r for r in lines if r[4].month > 1]
    assert kept(state, *WINDOWS[0]) == plain(left, *WINDOWS[0])

    fewer = MonthlyState(spark, root, extracts, SCHEMA, member(spark, {k: s for k, s in SCOPE.items() if s != "x_0"}))
    assert fewer.update().months == ["2024-02"]
    counts, _, _ = kept(fewer, *WINDOWS[0])
    assert counts == {k: n for k, n in plain(left, *WINDOWS[0])[0].items() if k[0] != "x_0"}


def test_an_update_writes_and_looks_up_no_more_than_it_needs(spark, tmp_path, monkeypatch):
    """Lines are not written again beside the extracts, facts have only the columns that are read, and orders' numbers are looked up once."""
    lines = some_lines(5, 300, date(2024, 1, 1), 60)
    add(spark, f"{tmp_path}/extracts", lines)
    written, looked_up, stage, numbered = {}, [], monthly.stage, MonthlyState._numbered
    monkeypatch.setattr(monthly, "stage", lambda df, label: written.setdefault(label, stage(df, label)))
    monkeypatch.setattr(MonthlyState, "_numbered", lambda self, facts, kind, *keep: looked_up.append(kind) or numbered(self, facts, kind, *keep))
    state = MonthlyState(spark, f"{tmp_path}/state", f"{tmp_path}/extracts", SCHEMA, member(spark))
    state.update()
    assert sorted(written) == ["changed-buyers", "changed-facts"] and sorted(looked_up) == ["customers", "orders", "skus"]
    assert set(written["changed-facts"].columns) == {"dt", "scope_id", "item_sku_id", "user_id", "parent_sale_ord_id", "sale_ord_dt", "sale_qtty", "before_prefr_amount"}
    window = date(2024, 1, 1), date(2024, 4, 30)
    assert kept(state, *window) == plain(lines, *window)
