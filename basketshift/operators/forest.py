"""Random forests of all scopes, grown level by level in one job.

Every level is one aggregation: tasks add up weights and labels by (scope, tree, node, feature, bin) over their blocks, the sums
meet, and the best split of every node of every tree of every scope is picked from its histogram. A pair takes part in a tree
as often as a Poisson number says that is hashed from the pair, and a node chooses among a third of the features. Blocks are only read; which node a pair has reached follows from the splits so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.operators.blocks import BITS, Block, blocks_of, names_of, to_blocks
from basketshift.session import stage


@dataclass(frozen=True)
class ForestParams:
    trees: int = 50
    depth: int = 6
    # Bins of nearly equal weight, cut at the borders of 2 ** cell_bits cells of equal width.
    bins: int = 32
    cell_bits: int = 10
    # A node looks at one in so many of its scope's features.
    share: int = 3
    # A split must explain more than this share of the node's squared sum.
    least_gain: float = 1e-9


NODE = ["scope_id", "tree", "node"]
STATS = "scope_id string, tree int, node int, feature int, bin int, n bigint, s bigint"


def feature_cuts(blocks: DataFrame, p: ForestParams) -> DataFrame:
    """cuts: for each feature of a scope the cells at which a new bin starts."""
    shift = BITS - p.cell_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks_of(batches):
            z = Block.of(row).z >> shift
            for f in range(z.shape[1]):
                cell, n = np.unique(z[:, f], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([row["scope_id"]] * len(cell)), pa.array(np.full(len(cell), f, dtype=np.int32)),
                                                  pa.array(cell.astype(np.int32)), pa.array(n)], names=["scope_id", "feature", "cell", "n"])

    cells = (blocks.mapInArrow(count, "scope_id string, feature int, cell int, n bigint")
             .groupBy("scope_id", "feature", "cell").agg(F.sum("n").alias("n")))
    every = Window.partitionBy("scope_id", "feature")
    below = F.sum("n").over(every.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    binned = cells.withColumn("bin", F.floor(below * p.bins / F.sum("n").over(every)))
    starts = binned.groupBy("scope_id", "feature", "bin").agg(F.min("cell").alias("cell")).where("bin > 0")
    return starts.groupBy("scope_id").agg(F.array_sort(F.collect_list(F.struct("feature", "cell"))).alias("cuts"))


def bin_blocks(blocks: DataFrame, p: ForestParams) -> DataFrame:
    """Blocks whose z holds bins, one byte each."""
    shift = BITS - p.cell_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks_of(batches):
            cells = Block.of(row).z >> shift
            bins = np.zeros(cells.shape, dtype=np.uint8)
            for f in range(cells.shape[1]):
                bins[:, f] = np.searchsorted([c["cell"] for c in row["cuts"] or [] if c["feature"] == f], cells[:, f], side="right")
            out = {k: [row[k]] for k in ("scope_id", "block", "names", "rows", "label", "weights")} | {"z": [bins.tobytes()]}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("scope_id", pa.string()), ("block", pa.int32()), ("names", pa.list_(pa.string())), ("rows", pa.int32()), ("label", pa.binary()),
                ("weights", pa.binary()), ("z", pa.binary())]))

    cut = blocks.join(blocks.select("scope_id", "block").join(feature_cuts(blocks, p), "scope_id", "left"), ["scope_id", "block"])
    return cut.mapInArrow(run, "scope_id string, block int, names array<string>, rows int, label binary, weights binary, z binary")


@lru_cache(maxsize=4096)
def chosen_features(names: tuple[str, ...], tree: int, node: int, share: int) -> tuple[int, ...]:
    """Those that a node may split by: the first third in the order of a hash of tree, node and name."""
    order = sorted(range(len(names)), key=lambda f: hashlib.md5(f"{tree}|{node}|{names[f]}".encode()).hexdigest())
    return tuple(sorted(order[:-(-len(names) // share)]))


def histograms(level: DataFrame, depth: int, p: ForestParams) -> DataFrame:
    """Weights and weighted labels by (scope, tree, node, feature, bin) for the nodes at ``depth``."""
    first = 1 << depth

    def grown(row: dict) -> tuple[np.ndarray, np.ndarray]:
        feature, cut = np.full((p.trees, first), -1, dtype=np.int64), np.zeros((p.trees, first), dtype=np.int64)
        for s in row.get("splits") or []:
            feature[s["tree"], s["node"]], cut[s["tree"], s["node"]] = s["feature"], s["bin"]
        return feature, cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks_of(batches):
            names, n = tuple(row["names"]), row["rows"]
            bins = np.frombuffer(row["z"], dtype=np.uint8).reshape(n, len(names))
            label = np.frombuffer(row["label"], dtype="<i8")
            weights = np.frombuffer(row["weights"], dtype=np.uint8).reshape(n, -1)
            feature, cut = grown(row)
            for tree in range(p.trees):
                at = np.nonzero(weights[:, tree])[0]
                node = np.ones(len(at), dtype=np.int64)
                for _ in range(depth):
                    f = feature[tree, node]
                    at, node, f = at[f >= 0], node[f >= 0], f[f >= 0]
                    node = 2 * node + (bins[at, f] > cut[tree, node])
                if not len(at):
                    continue
                allowed = np.zeros((first, len(names)), dtype=bool)
                for x in np.unique(node).tolist():
                    allowed[x - first, list(chosen_features(names, tree, x, p.share))] = True
                w = weights[at, tree].astype(np.int64)
                for f in range(len(names)):
                    sel = np.nonzero(allowed[node - first, f])[0]
                    if not len(sel):
                        continue
                    # Sums of a block are below 2 ** 53, so doubles hold them exactly.
                    key = (node[sel] - first) * 256 + bins[at[sel], f]
                    count, total = np.bincount(key, w[sel]), np.bincount(key, w[sel] * label[at[sel]])
                    full = np.nonzero(count)[0]
                    k = len(full)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["scope_id"]] * k), pa.array(np.full(k, tree, dtype=np.int32)), pa.array((full // 256 + first).astype(np.int32)),
                         pa.array(np.full(k, f, dtype=np.int32)), pa.array((full % 256).astype(np.int32)), pa.array(count[full].astype(np.int64)),
                         pa.array(total[full].astype(np.int64))], names=["scope_id", "tree", "node", "feature", "bin", "n", "s"])

    return level.mapInArrow(run, STATS).groupBy(*NODE, "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def best_splits(stats: DataFrame, p: ForestParams) -> DataFrame:
    """Each node's split of largest gain (ties: the first feature, the lowest bin): rows up to ``bin`` go left."""
    every = Window.partitionBy(*NODE, "feature")
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = stats.select(*NODE, "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
                        F.sum("n").over(every).alias("n"), F.sum("s").over(every).alias("s")).where("nl < n")

    def part(s, n):
        return s.cast("double") * s.cast("double") / n

    whole = part(F.col("s"), F.col("n"))
    gain = part(F.col("sl"), F.col("nl")) + part(F.col("s") - F.col("sl"), F.col("n") - F.col("nl")) - whole
    good = sums.withColumn("gain", gain).where(F.col("gain") > whole * p.least_gain)
    best = good.groupBy(*NODE).agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))).alias("best"))
    return best.select(*NODE, (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"), "best.gain")


def grow(blocks: DataFrame, p: ForestParams = ForestParams()) -> DataFrame:
    """The splits of all trees of all scopes: scope_id, tree, node (1 is the root, 2i and 2i + 1 the children of i), feature, bin, gain."""
    binned = stage(bin_blocks(blocks, p), "bins")
    splits, level = None, binned
    for depth in range(p.depth):
        found = stage(best_splits(histograms(level, depth, p), p), "splits")
        splits = found if splits is None else splits.unionByName(found)
        # Scopes without a new split are done.
        so_far = splits.join(found.select("scope_id").distinct(), "scope_id", "left_semi").groupBy("scope_id").agg(
            F.collect_list(F.struct("tree", "node", "feature", "bin")).alias("splits"))
        level = to_blocks(binned, so_far)
    return splits


def importances(blocks: DataFrame, p: ForestParams = ForestParams()) -> DataFrame:
    """scope_id, name and weight of every feature: its share of each tree's gain, averaged over the scope's trees that split."""
    gains = grow(blocks, p).groupBy("scope_id", "tree", "feature").agg(F.sum("gain").alias("gain"))
    shares = gains.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy("scope_id", "tree")))
    by_feature = shares.groupBy("scope_id", "feature").agg(F.sum("share").alias("weight"))
    named = names_of(blocks).select("scope_id", F.posexplode("names").alias("feature", "name"))
    return named.join(by_feature, ["scope_id", "feature"], "left").select("scope_id", "name", F.coalesce("weight", F.lit(0.0)).alias("weight"))
