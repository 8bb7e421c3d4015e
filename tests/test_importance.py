"""Forests and elastic nets of all scopes at once, against plain loops over one scope at a time."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketshift.operators import blocks as B
from basketshift.operators import elastic_net, forest
from basketshift.operators import importance as M
from tests.test_attributes import MAPS

TREES, DEPTH = 7, 3


def rows(seed, sizes):
    rng, out = random.Random(seed), []
    for scope, n in sizes.items():
        for i in range(n):
            x = rng.random()
            sims = {"a": rng.choice([0.0, 1.0]), "b": x, f"own {scope}": rng.random()}
            if i % 17 == 3:
                sims["b"] = None
            out.append((scope, f"s{i}", f"d{i % 5}", 0.3 * x * x + 0.05 * rng.random(), 10 ** rng.uniform(0, 6), None if scope == "one" else 5.0 * i, sims))
    return out


def plain(data, scope):
    """Features, whole values, bins, labels and weights of one scope."""
    mine = [r for r in data if r[0] == scope]
    names = sorted({k for r in mine for k, v in r[6].items() if v is not None})
    names += [n for n, i in (("fromSales", 4), ("toSales", 5)) if any(r[i] is not None for r in mine)]
    table, pairs, labels = [], [], []
    for r in mine:
        v = [r[6].get(n) for n in names if n not in ("fromSales", "toSales")] + [x for n, x in (("fromSales", r[4]), ("toSales", r[5])) if n in names]
        if all(x is not None for x in v):
            table.append([int(np.floor(x * (100 if n.endswith("Sales") else 1_000_000) + 0.5)) for n, x in zip(names, v)])
            pairs.append(r[1:3])
            labels.append(int(np.floor(r[3] * 1_000_000_000 + 0.5)))
    table = np.array(table)
    low, high = table.min(0), table.max(0)
    z = np.floor((table - low) / (high - low + 1.0) * (1 << 20)).astype(int)
    cells = z >> 10
    bins = np.zeros_like(cells)
    for f in range(len(names)):
        for i in range(len(cells)):
            bins[i, f] = (cells[:, f] < cells[i, f]).sum() * 32 // len(cells)
    return names, z, bins, np.array(labels), pairs


def plain_forest(names, bins, labels, pairs):
    weights = B.poisson_weights([p[0] for p in pairs], [p[1] for p in pairs], TREES, 7).astype(int)
    total = dict.fromkeys(names, 0.0)
    for t in range(TREES):
        gains = dict.fromkeys(names, 0.0)

        def split(node, at, depth):
            if depth == DEPTH or not len(at):
                return
            w, y = weights[at, t], labels[at]
            n, s = float(w.sum()), float((w * y).sum())
            best = None
            for f in forest.chosen_features(tuple(names), t, node, 3):
                for b in sorted(set(bins[at, f])):
                    left = bins[at, f] <= b
                    nl, sl = float(w[left].sum()), float((w * y)[left].sum())
                    if nl < n:
                        gain = sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n
                        if gain > s * s / n * 1e-9 and (best is None or gain > best[0]):
                            best = gain, f, b
            if best:
                gains[names[best[1]]] += best[0]
                left = bins[at, best[1]] <= best[2]
                split(2 * node, at[left], depth + 1)
                split(2 * node + 1, at[~left], depth + 1)

        split(1, np.nonzero(weights[:, t])[0], 0)
        whole = sum(gains.values())
        for k, g in gains.items():
            total[k] += g / whole if whole else 0.0
    return total


@pytest.mark.parametrize("block_rows", [B.BLOCK_ROWS, 60])
def test_forests_equal_recursion(spark, block_rows):
    data = rows(3, {"large": 400, "small": 60, "one": 90})
    data += [("flat", f"s{i}", "d", 0.25, 1.0, float(i), {"k": float(i % 3)}) for i in range(20)]
    blocks = B.feature_blocks(spark.createDataFrame(data, MAPS), TREES, 7, block_rows)
    assert blocks.count() > (4 if block_rows == 60 else 0)
    found = {}
    for r in forest.importances(blocks, forest.ForestParams(trees=TREES, depth=DEPTH)).collect():
        found.setdefault(r["scope_id"], {})[r["name"]] = r["weight"]
    assert set(found) == {"large", "small", "one", "flat"} and set(found["flat"].values()) == {0.0}
    for scope in ("large", "small", "one"):
        names, _, bins, labels, pairs = plain(data, scope)
        assert found[scope] == pytest.approx(plain_forest(names, bins, labels, pairs))


def test_without_a_penalty_coefficients_are_least_squares(spark):
    data = rows(5, {"large": 300, "small": 40})
    blocks = B.feature_blocks(spark.createDataFrame(data, MAPS), trees=0, block_rows=64)
    found = {}
    for r in elastic_net.importances(blocks, elastic_net.NetParams(penalty=0.0, sweeps=400)).collect():
        found.setdefault(r["scope_id"], {})[r["name"]] = r["weight"]
    for scope in found:
        names, z, _, labels, _ = plain(data, scope)
        y = np.floor((labels - labels.min()) / (labels.max() - labels.min() + 1.0) * (1 << 20))
        x = (z - z.mean(0)) / z.std(0)
        want = np.linalg.lstsq(x, (y - y.mean()) / y.std(), rcond=None)[0]
        assert found[scope] == pytest.approx(dict(zip(names, np.abs(want))), abs=1e-6)


def test_columns_that_do_not_vary_weigh_nothing():
    gram = {(i, j): int(v) for (i, j), v in np.ndenumerate(np.array([[4, 8, 6, 6], [8, 16, 12, 12], [6, 12, 14, 14], [6, 12, 14, 14]])) if i <= j}
    r = elastic_net.correlations(gram, 4)
    assert r[0].tolist() == [0, 0, 0] and r[1, 2] == pytest.approx(1)
    assert elastic_net.descend(r, elastic_net.NetParams(penalty=0.0)).tolist() == pytest.approx([0, 1])


def test_poisson_weights_have_mean_and_variance_one():
    w = B.poisson_weights([str(i) for i in range(4000)], ["d"] * 4000, 20, 7)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05
    assert np.array_equal(w[7:9], B.poisson_weights(["7", "8"], ["d", "d"], 20, 7))


def test_no_job_per_scope(spark):
    """As many jobs for many scopes as for one."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(scopes):
        group = f"forest-{scopes}"
        maps = spark.createDataFrame(rows(1, {f"s{i}": 20 for i in range(scopes)}), MAPS)
        spark.sparkContext.setJobGroup(group, group)
        M.cdt_rf(maps)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(12) <= jobs(1) + 6


def test_nothing_to_fit(spark):
    maps = spark.createDataFrame(rows(1, {"a": 3}), MAPS)
    assert M.cdt_rf(maps.where("false")).count() == 0 and M.cdt_enet(maps.where("false")).count() == 0
    bare = maps.withColumns({"fromSales": F.lit(None).cast("double"), "toSales": F.lit(None).cast("double"), "sims": F.lit(None).cast("map<string,double>")})
    assert M.cdt_rf(bare).count() == 0
