"""Worked examples, invariants and cross-checks of both substitution paths."""

from __future__ import annotations

import itertools
import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketshift.operators import baskets as B
from basketshift.operators import coview as V
from basketshift.operators import facts as X
from basketshift.operators import pairs as P
from basketshift.operators import prefix
from basketshift.operators import switching as W
from basketshift.params import Params
from basketshift.plans.order_path import OrderInputs, OrderPath
from basketshift.sources import schemas

SCOPE = "1_11_c_self_lvl3_c_sku"
LINES = schemas.ORDER_LINES + ", sale_ord_dt date, sale_ord_valid_flag int"


def line(user, day, order, item, amount, qty=1.0, valid=1, paid=None):
    ts = day if isinstance(day, datetime) else datetime(day.year, day.month, day.day)
    before = Decimal(amount).quantize(Decimal("0.01"))
    after = before if paid is None else Decimal(paid)
    return (user, order, item, f"{order}-{item}", ts, qty, after, before, ts.date(), valid)


def d(text):
    return date.fromisoformat(text)


EXAMPLE = [
    line("u1", d("2017-01-02"), "p1", "A", 60), line("u1", d("2017-01-02"), "p1", "B", 40),
    line("u1", d("2017-01-10"), "p2", "A", 30), line("u1", d("2017-01-10"), "p2", "C", 70),
    line("u1", d("2017-01-20"), "p3", "B", 50),
    line("u2", d("2017-01-03"), "p4", "A", 100),
    line("u2", d("2017-01-12"), "p5", "B", 20), line("u2", d("2017-01-12"), "p5", "C", 80),
    line("u3", d("2017-01-05"), "p6", "C", 10),
] + [line(f"u{i}", d("2017-01-06"), f"p{i + 3}", "D", 10) for i in range(4, 9)]


def scope_frame(spark, ids=(SCOPE,)):
    rows = [(i, i, *i.split("_")) for i in ids]
    return spark.createDataFrame(rows, "scope_id string, super_scope_id string, item_first_cate_cd string, item_second_cate_cd string, "
                                       "item_third_cate_cd string, self_pop string, scope_type string, scope_desc string, item_type string")


def sku_frame(spark, items, cid3="c"):
    return spark.createDataFrame([(i, f"name {i}", cid3, "self") for i in items], "item_sku_id string, sku_name string, cid3 string, sku_type string")


def run(spark, lines, **kw):
    kw = {"end_date": d("2017-12-31"), "start_date": d("2017-01-01"), "basket_by_day": True, **kw}
    items = sorted({r[2] for r in lines})
    return OrderPath(OrderInputs(spark.createDataFrame(lines, LINES), sku_frame(spark, items), scope_frame(spark)), Params(**kw))


def detail(path):
    return {(r["from_item_id"], r["item_id"]): r.asDict() for r in path.detail.collect()}


def test_worked_order_example(spark):
    path = run(spark, EXAMPLE)
    got = detail(path)
    want = {
        ("A", "A"): (36, 0, 36, 0, 36, 0.086799), ("A", "B"): (85, 0.479965, 125.797026, -0.198020, 100.886724, 0.243247),
        ("A", "C"): (244, 0.419969, 346.472529, -0.198020, 277.864108, 0.669954),
        ("B", "A"): (24, 0.479965, 35.519160, -0.198020, 28.485663, 0.327384),
        ("B", "C"): (56, 0.303120, 72.974729, -0.198020, 58.524287, 0.672616),
        ("C", "B"): (105, 0.303120, 136.827616, -0.198020, 109.733039, 1),
    }
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        assert [g[c] for c in ("spendswitch", "cr", "spendswitch_ca", "ci", "spendswitch_ad", "switch_prob")] == pytest.approx(w, abs=1e-6)
    theil = {r["user_id"]: (r["t"], r["comp_index"]) for r in path.theil.collect()}
    assert theil.keys() == {"u1", "u2", "u3"}
    assert theil["u1"] == pytest.approx((0.00600121, 0.9999271), abs=1e-6)
    assert theil["u2"] == pytest.approx((0.14132729, 0.94725048), abs=1e-6)
    assert theil["u3"] == pytest.approx((1, -1))


def test_worked_example_without_lift(spark):
    got = detail(run(spark, EXAMPLE[:9]))
    assert all(r["ci"] == 0 for r in got.values())
    assert got["A", "B"]["switch_prob"] == pytest.approx(0.247501, abs=1e-6)


def test_sku_in_scope_keeps_items_that_never_switch(spark):
    rows = run(spark, EXAMPLE).sku_in_scope.collect()
    assert {r["item_id"] for r in rows} == {"A", "B", "C", "D"}


def random_lines(seed, users=25, items=8, hot=None):
    rng, out = random.Random(seed), []
    for u in range(users):
        for o in range(rng.randint(1, 6)):
            day = d("2017-01-01") + timedelta(days=rng.randint(0, 300))
            n = hot if hot and u == 0 else rng.randint(1, 4)
            for i in rng.sample(range(max(items, n)), n):
                out.append(line(f"u{u}", day, f"o{u}-{o}", f"i{i}", rng.randint(1, 90), qty=float(rng.randint(1, 5))))
    return out


def brute_force(lines, by_day):
    """The definitions as loops over one scope without thresholds."""
    spend, order_ids = defaultdict(float), set()
    for r in lines:
        key = r[8] if by_day else (r[4], r[1])
        spend[r[0], key, r[2]] += float(r[7])
        order_ids.add(r[1])
    users = defaultdict(lambda: defaultdict(dict))
    for (u, k, i), a in spend.items():
        users[u][k][i] = a
    flow, dst = defaultdict(float), set()
    for u, bs in users.items():
        seq = [bs[k] for k in sorted(bs)]
        for b0, b1 in zip(seq, seq[1:]):
            t0, t1 = sum(b0.values()), sum(b1.values())
            for (i, a), (j, b) in itertools.product(b1.items(), b0.items()):
                flow[j, i] += a / t1 * b / t0 * (t1 + t0)
                dst.add(i)
    nb, num, den, ab, count = len(dst), defaultdict(float), defaultdict(float), defaultdict(int), defaultdict(int)
    for u, bs in users.items():
        s = defaultdict(float)
        for b in bs.values():
            for i, a in b.items():
                count[i] += 1
                if i in dst:
                    s[i] += a
        comp = None
        if s and nb > 1:
            m = sum(s.values()) / nb
            t = sum(x / m * math.log(x / m) for x in s.values()) / (nb * math.log(nb))
            comp = (1 - 2 * t) / (2 * t * t - 2 * t + 1)
        for b in bs.values():
            for i, j in itertools.permutations(b, 2):
                ab[j, i] += 1
                if i in dst and j in dst and comp is not None:
                    num[j, i] += 2 * b[i] * b[j] / sum(b.values()) * comp
                    den[j, i] += b[i] + b[j]
    adjusted = {}
    for (j, i), ss in flow.items():
        if i in dst and j in dst:
            cr = num[j, i] / den[j, i] if den[j, i] else 0
            lift = ab[j, i] / count[j] / count[i] * len(order_ids)
            ci = min((1 - lift ** 2) / (1 + lift ** 2), 0) if ab[j, i] else 0
            adjusted[j, i] = ss * (1 + cr) * (1 + ci)
    total = defaultdict(float)
    for (j, _), x in adjusted.items():
        total[j] += x
    return {k: x / total[k[0]] for k, x in adjusted.items()}


@pytest.mark.parametrize("by_day", [True, False])
@pytest.mark.parametrize("block", [512, 3])
def test_matches_brute_force_with_a_hot_basket(spark, by_day, block):
    """One customer's baskets hold most lines; with blocks of 3 items they are split."""
    lines = random_lines(3, hot=20)
    got = {k: r["switch_prob"] for k, r in detail(run(spark, lines, basket_by_day=by_day, block_items=block)).items()}
    want = brute_force(lines, by_day)
    assert got.keys() == want.keys()
    assert got == pytest.approx(want, abs=1e-9)


def test_invariants(spark):
    path = run(spark, random_lines(11, users=60))
    rows = path.detail.collect()
    total = defaultdict(float)
    pairs = {(r["from_item_id"], r["item_id"]): r for r in rows}
    for r in rows:
        total[r["from_item_id"]] += r["switch_prob"]
        assert 0 <= r["switch_prob"] <= 1 and -0.5 <= r["cr"] <= 0.5 and -1 < r["ci"] <= 0
        back = pairs.get((r["item_id"], r["from_item_id"]))
        if back is not None:
            assert (r["cr"], r["ci"]) == pytest.approx((back["cr"], back["ci"]))
    assert all(v == pytest.approx(1) for v in total.values())
    for r in path.theil.collect():
        assert -1e-9 <= r["t"] <= 1 + 1e-9
    per_pair = path.adjacent.groupBy("scope_id", "user_id", "seqnum").agg(F.sum("spendswitch").alias("s"))
    totals = path.baskets.select("scope_id", "user_id", "seqnum", "basket_amount").distinct()
    prev = totals.select("scope_id", "user_id", (F.col("seqnum") + 1).alias("seqnum"), F.col("basket_amount").alias("prev"))
    checked = per_pair.join(totals, ["scope_id", "user_id", "seqnum"]).join(prev, ["scope_id", "user_id", "seqnum"]).collect()
    assert checked and all(r["s"] == pytest.approx(r["basket_amount"] + r["prev"]) for r in checked)


def test_scopes_do_not_influence_each_other(spark):
    a, b = random_lines(5), random_lines(6)
    b = [(*r[:2], "x" + r[2], *r[3:]) for r in b]
    ids = [SCOPE, SCOPE.replace("_c_", "_e_")]
    skus = sku_frame(spark, {r[2] for r in a}).union(sku_frame(spark, {r[2] for r in b}, "e"))
    p = Params(end_date=d("2017-12-31"), start_date=d("2017-01-01"), prod_tail=0.9, max_baskets=5)
    lines = spark.createDataFrame(a + b, LINES)
    both = OrderPath(OrderInputs(lines, skus, scope_frame(spark, ids)), p)
    whole = {(r[0], r[1], r[2]): r[3] for r in both.switching.collect()}
    single = {}
    for i in ids:
        alone = OrderPath(OrderInputs(lines, skus, scope_frame(spark, [i])), p)
        single |= {(r[0], r[1], r[2]): r[3] for r in alone.switching.collect()}
    assert whole == pytest.approx(single) and len({k[0] for k in whole}) == 2


def test_customer_limits_are_inclusive_and_anonymous_users_go(spark):
    lines = [line(u, d("2017-01-01") + timedelta(days=i), f"{u}{i}", "A", 10)
             for u, n in (("one", 1), ("two", 2), ("three", 3), ("four", 4), ("-1", 2), (None, 2)) for i in range(n)]
    p = run(spark, lines, min_baskets=2, max_baskets=3)
    kept = {r["user_id"] for r in X.customer_filter(p.facts, p.customers, p.p).select("user_id").distinct().collect()}
    assert kept == {"two", "three"}
    dropped_early = X.drop_hot_strangers(p.facts, p.customers, p.p)
    assert {r["user_id"] for r in dropped_early.select("user_id").distinct().collect()} == {"two", "three"}
    assert {r["user_id"] for r in p.baskets.select("user_id").distinct().collect()} == {"two", "three"}


def test_line_filters(spark):
    rows = [line("u", d("2017-02-01"), "a", "full", 100, paid="100"), line("u", d("2017-02-01"), "a", "edge", 100, paid="95"),
            line("u", d("2017-02-01"), "a", "promo", 100, paid="94.99"), line("u", d("2017-02-01"), "a", "free", 0),
            line("u", d("2017-02-01"), "a", "returned", 10, qty=-1.0)]
    df = spark.createDataFrame(rows, LINES)
    assert {r["item_sku_id"] for r in X.nonpromo_filter(df).collect()} == {"full", "edge"}
    assert {r["item_sku_id"] for r in X.positive_filter(df).collect()} == {"full", "edge", "promo"}


def test_window_is_inclusive_and_orders_valid(spark):
    rows = [line("u", d(x), x, "A", 1) for x in ("2016-12-31", "2017-01-01", "2017-12-31", "2018-01-01")]
    rows.append(line("u", d("2017-05-05"), "void", "A", 1, valid=0))
    assert {r[0] for r in run(spark, rows).facts.select("parent_sale_ord_id").collect()} == {"2017-01-01", "2017-12-31"}


@pytest.mark.parametrize("share,kept", [(0.9, "ab"), (0.4, ""), (0.95, "abc"), (0.5, "a")])
def test_prod_tail(spark, share, kept):
    rows = [("s", i, q / 2, d(day), 1.0) for i, q in (("a", 50.0), ("b", 30.0), ("c", 15.0), ("d", 5.0)) for day in ("2017-01-01", "2017-01-02")]
    df = X.sku_daily(spark.createDataFrame(rows, "scope_id string, item_sku_id string, sale_qtty double, sale_ord_dt date, before_prefr_amount double"))
    assert {r["item_sku_id"] for r in X.prod_tail(df, share).collect()} == set(kept)


def test_running_total_over_slices(spark):
    """Many ties and one group with most rows: the slices must add up to one running total."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", f"k{i:04}", rng.randint(1, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k string, v long").repartition(5)
    out = prefix.running_total(df, "g", [F.col("v").desc(), F.col("k")], "v", "run", "total")
    got = {r["k"]: (r["run"], r["total"]) for r in out.collect()}
    groups = defaultdict(list)
    for g, k, v in rows:
        groups[g].append((-v, k))
    want = {}
    for g in groups.values():
        run, total = 0, -sum(v for v, _ in g)
        for v, k in sorted(g):
            run -= v
            want[k] = (run, total)
    assert got == want


def test_active_weeks_and_threshold_edges(spark):
    rows = [line("u", d("2017-01-01") + timedelta(days=i), f"o{i}", "A", 10) for i in (0, 6, 7, 13, 14)]
    p = run(spark, rows, min_weeks=3, min_sales=50)
    assert [r["weeknum"] for r in X.active_weeks(p.mapped_daily, p.p).collect()] == [3]
    assert X.item_min_sales(p.mapped_daily, 50).count() == 0 and X.item_min_sales(p.mapped_daily, 49.99).count() == 1
    assert p.eligible.count() == 0
    q = run(spark, rows, min_weeks=3, min_sales=49)
    assert q.eligible.count() == 1


def test_basket_numbers(spark):
    t = datetime(2017, 3, 1, 10, 0, 0)
    rows = [line("u", t, "b", "A", 1), line("u", t.replace(microsecond=500000), "a", "A", 1), line("u", t + timedelta(hours=1), "c", "A", 1),
            line("u", t + timedelta(days=1), "d", "B", 1), line("v", t, "e", "A", 1)]
    df = spark.createDataFrame(rows, LINES).withColumns({"scope_id": F.lit("s"), "item_id": F.col("item_sku_id")})
    by_order = {r["parent_sale_ord_id"]: r["seqnum"] for r in B.number_baskets(B.purchases(df, False), False).collect()}
    assert by_order == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 1}
    by_day = B.basket_rows(B.purchases(df, True), True)
    got = {(r["user_id"], r["seqnum"]): (r["amount"], r["prev_count"], r["next_count"]) for r in by_day.collect()}
    assert got == {("u", 1): (30000, None, 1), ("u", 2): (10000, 1, None), ("v", 1): (10000, None, None)}
    for days in (True, False):
        assert run(spark, rows, basket_by_day=days).n_orders.first()["n_orders"] == 5


# -- clicks -------------------------------------------------------------------

VIEWS = "scope_id string, user_log_acct string, session_id string, request_dt date, item_id string"


def views(spark, rows):
    return spark.createDataFrame([("s", u, s, d("2024-01-01"), i) for u, s, i in rows], VIEWS)


def test_worked_click_example(spark):
    rows = [("a", "s1", "X"), ("a", "s1", "X"), ("a", "s1", "Y"), ("b", "s2", "X"), ("b", "s2", "Z"), (None, "s3", "X"), (None, "s3", "Y")]
    counts = V.coview_counts(views(spark, rows), 512)
    got = {r["src_item_id"] + r["dst_item_id"]: r["page_views"] for r in counts.collect()}
    assert got == {"XX": 5, "XY": 2, "XZ": 1, "YX": 2, "YY": 1, "ZX": 1, "ZZ": 1}
    probs = {r["src_item_id"] + r["dst_item_id"]: r["switching_prob"] for r in V.switching(counts).collect()}
    assert probs == pytest.approx({"XX": .625, "XY": .25, "XZ": .125, "YX": 2 / 3, "YY": 1 / 3, "ZX": .5, "ZZ": .5})


@pytest.mark.parametrize("block", [512, 2])
def test_coview_with_a_hot_session(spark, block):
    rng = random.Random(2)
    rows = [("hot", "s", f"i{rng.randint(0, 30)}") for _ in range(200)]
    rows += [(f"u{u}", f"s{s}", f"i{rng.randint(0, 12)}") for u in range(20) for s in range(3) for _ in range(rng.randint(1, 5))]
    sessions = defaultdict(list)
    for u, s, i in rows:
        sessions[u, s].append(i)
    want = defaultdict(int)
    for items in sessions.values():
        for a, b in itertools.product(items, items):
            want[a, b] += 1
    got = {(r["src_item_id"], r["dst_item_id"]): r["page_views"] for r in V.coview_counts(views(spark, rows), block).collect()}
    assert got == dict(want)


def test_block_join_is_the_plain_join(spark):
    left = spark.range(0, 40).select((F.col("id") % 3).alias("k"), F.concat(F.lit("l"), "id").alias("a"))
    right = spark.range(0, 50).select((F.col("id") % 4).alias("k"), F.concat(F.lit("r"), "id").alias("b"))
    nl = left.groupBy("k").agg(F.count("a").alias("nl"))
    nr = right.groupBy("k").agg(F.count("b").alias("nr"))
    sizes = nl.join(nr, "k")
    plain = left.join(right, "k")
    split = P.block_join(left.join(sizes, "k"), right.join(sizes.withColumnsRenamed({"nl": "ml", "nr": "mr"}), "k"), ["k"], left_item="a",
                         right_item="b", left_count=("nl", "nr"), right_count=("mr", "ml"), size=4)
    assert sorted(plain.select("k", "a", "b").collect()) == sorted(split.select("k", "a", "b").collect())


def test_amounts_below_a_hundredth_count(spark):
    """A line of 0.004 is summed as it is; one that is 0 at four decimals is left out; no total is a zero divisor."""
    from basketshift.functions import columns as C
    from basketshift.operators import facts as X

    lines = spark.createDataFrame([("a", 1.0, 0.004), ("b", 1.0, 0.00001), ("c", 0.0, 5.0), ("d", 1.0, 0.9499)], "id string, sale_qtty double, before_prefr_amount double")
    kept = X.positive_filter(lines)
    assert [(r[0], r[1]) for r in kept.select("id", C.units(C.scaled("before_prefr_amount"))).collect()] == [("a", 0.004), ("d", 0.9499)]
    promo = lines.withColumn("after_prefr_amount", C.F.lit(0.9030))
    assert [r[0] for r in X.nonpromo_filter(promo.where("id = 'd'"), "0.951").collect()] == []
    assert [r[0] for r in X.nonpromo_filter(promo.where("id = 'd'"), "0.9506").collect()] == ["d"]
    assert spark.range(1).select(C.within_spend(C.F.lit(1.0), C.F.lit(1.0), C.F.lit(0.0))).first()[0] is None


@pytest.mark.parametrize("size", [1, 2, 512])
def test_neighbour_join_is_two_plain_joins(spark, size):
    """Whatever the size of blocks: each pair of a basket and the one before once, and each two items of a basket once."""
    rng = random.Random(size)
    rows = []
    for user in range(6):
        baskets = [sorted(rng.sample("abcdefg", rng.randrange(1, 6))) for _ in range(rng.randrange(1, 6))]
        for n, items in enumerate(baskets):
            near = [len(baskets[n + d]) if 0 <= n + d < len(baskets) else None for d in (-1, 1)]
            rows += [(user, n + 1, i, len(items), *near) for i in items]
    df = spark.createDataFrame(rows, "user int, seqnum int, item string, item_count bigint, prev_count bigint, next_count bigint")
    got = sorted((r["user"], r["_at"], r["_adjacent"], r["item_a"], r["item_b"]) for r in
                 P.neighbour_join(df, ["user"], "seqnum", item="item", values=[], size=size).collect())
    want = [(a[0], a[1], True, a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] == b[1] + 1]
    want += [(a[0], a[1], False, a[2], b[2]) for a in rows for b in rows if a[:2] == b[:2] and a[2] < b[2]]
    assert got == sorted(want)


@pytest.mark.parametrize("by_day", [True, False])
def test_spread_baskets_equal_windows_by_customer(spark, by_day):
    """Ties, null orders, a customer with half of all baskets, customers of one basket."""
    rng = random.Random(12)
    t = datetime(2017, 3, 1, 10)
    rows = []
    for user in range(40):
        for _ in range(600 if user == 0 else rng.randrange(1, 9)):
            when = t + timedelta(hours=rng.randrange(200 if user else 9000))
            order = rng.choice([None, f"o{rng.randrange(400)}"])
            rows += [("s", f"u{user}", when, when.date(), order, i, 1, rng.randrange(1, 99)) for i in rng.sample("abcdef", rng.randrange(1, 4))]
    key = ["sale_ord_dt"] if by_day else ["sale_ord_tm", "parent_sale_ord_id"]
    df = spark.createDataFrame(rows, "scope_id string, user_id string, sale_ord_tm timestamp_ntz, sale_ord_dt date, parent_sale_ord_id string, item_id string, qty bigint, amount bigint")
    df = df.groupBy("scope_id", "user_id", *key, "item_id").agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
    a, b = (sorted(map(str, B.basket_rows(df, by_day, most).collect())) for most in (10, 2**31 - 1))
    assert a == b and len(a) == df.count()


def test_a_customer_with_half_of_all_baskets_is_spread_over_tasks(spark):
    from basketshift.operators import prefix

    df = spark.range(0, 40_000, numPartitions=8).select(F.lit("s").alias("scope_id"), F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"),
                                                        (F.col("id") * 7919 % 40_009).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = prefix.number_within(df, ["scope_id", "user_id"], [F.col("k")], "n").withColumn("task", F.spark_partition_id())
        tasks = {r["task"]: r["count"] for r in out.where("user_id = 'hot'").groupBy("task").count().collect()}
        top = out.where("user_id = 'hot'").agg(F.max("n"), F.countDistinct("n"), F.min("n")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(top) == (20_000, 20_000, 1) and len(tasks) >= 3 and max(tasks.values()) < 12_000
    assert out.where("user_id <> 'hot' and n <> 1").count() == 0
