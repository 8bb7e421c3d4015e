"""Pairs of all scopes as blocks of numbers, which the fits of all scopes read together.

A scope's features are its own attribute keys that have any value, and the sales. Features become whole numbers of 20 bits between
the smallest and the largest value of the scope, labels whole billionths, so that every sum is exact and no result depends on
how rows were dealt out. A scope has as many blocks as its pairs need, each of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.session import small_batches, stage

SALES = ("fromSales", "toSales")
BITS = 20
LABEL_SCALE = 1_000_000_000
# Decimals kept of similarities and of sales.
SIMILARITY_SCALE, SALES_SCALE = 1_000_000, 100
# Pairs of one block.
BLOCK_ROWS = 50_000

# The first seven sums of the Poisson distribution of mean 1, in 65,536ths.
POISSON = (24109, 48219, 60273, 64292, 65296, 65497, 65531)

BLOCK = "scope_id string, block int, names array<string>, rows int, z binary, label binary, weights binary, low bigint, high bigint"


@dataclass(frozen=True)
class Block:
    """One block: z is rows x features, weights rows x trees."""

    names: tuple[str, ...]
    z: np.ndarray
    label: np.ndarray
    weights: np.ndarray
    low: int
    high: int

    @staticmethod
    def of(row: dict) -> Block:
        n, m = row["rows"], len(row["names"])
        return Block(tuple(row["names"]), np.frombuffer(row["z"], dtype="<i4").reshape(n, m), np.frombuffer(row["label"], dtype="<i8"),
                     np.frombuffer(row["weights"], dtype=np.uint8).reshape(n, -1), row["low"], row["high"])


def features(maps: DataFrame) -> DataFrame:
    """keys (the attributes of a scope that have a value), which sales it has, and names, in the order of the features."""
    sales = maps.groupBy("scope_id").agg(*[(F.count(c) > 0).alias(f"has_{c}") for c in SALES])
    keys = (maps.select("scope_id", F.explode("sims").alias("k", "v")).where("v is not null")
            .groupBy("scope_id").agg(F.array_sort(F.collect_set("k")).alias("keys")))
    none = F.array().cast("array<string>")
    listed = [F.when(F.col(f"has_{c}"), F.array(F.lit(c))).otherwise(none) for c in SALES]
    found = sales.join(keys, "scope_id", "left").withColumn("keys", F.coalesce("keys", none))
    return stage(found.withColumn("names", F.concat("keys", *listed)).where(F.size("names") > 0), "names")


def usable_rows(maps: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs with a label and all features: the label and v, the features, as whole numbers."""
    none = F.array().cast("array<bigint>")

    def whole(x, scale):
        return F.round(x.cast("double") * scale).cast("bigint")

    sales = [F.when(F.col(f"has_{c}"), F.array(whole(F.col(c), SALES_SCALE))).otherwise(none) for c in SALES]
    sims = F.transform("keys", lambda k: whole(F.try_element_at("sims", k), SIMILARITY_SCALE))
    rows = maps.join(known, "scope_id").select(
        "scope_id", "src_item_id", "dst_item_id", "names", whole(F.col("switching_prob"), LABEL_SCALE).alias("label"), F.concat(sims, *sales).alias("v"))
    return rows.where(F.col("label").isNotNull() & ~F.exists("v", lambda x: x.isNull()))


def poisson_weights(src: list[str], dst: list[str], trees: int, seed: int) -> np.ndarray:
    """How often each pair is drawn by each tree: a Poisson number from a hash of the pair. rows x trees."""
    groups = -(-trees // 8)
    drawn = b"".join(hashlib.md5(f"{seed}|{s}|{d}|{g}".encode()).digest() for s, d in zip(src, dst, strict=True) for g in range(groups))
    u = np.frombuffer(drawn, dtype=">u2").reshape(len(src), groups * 8)[:, :trees]
    return np.searchsorted(np.array(POISSON), u, side="right").astype(np.uint8)


def feature_blocks(maps: DataFrame, trees: int = 50, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All scopes with two usable pairs or more, as blocks. ``maps`` has the pair, switching_prob, fromSales, toSales and sims."""
    small_batches(maps.sparkSession)
    known = features(maps)
    rows = stage(usable_rows(maps, known), "features")
    ends = rows.select("scope_id", F.posexplode("v").alias("pos", "x")).groupBy("scope_id", "pos").agg(F.min("x").alias("least"), F.max("x").alias("most"))
    ranges = ends.groupBy("scope_id").agg(F.array_sort(F.collect_list(F.struct("pos", "least", "most"))).alias("ranges"))
    counted = rows.groupBy("scope_id").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("n > 1")
    number = F.pmod(F.xxhash64("src_item_id", "dst_item_id"), F.ceil(F.col("n") / block_rows)).cast("int")

    def scaled(x, r):
        width = (r["most"] - r["least"] + 1).cast("double")
        return F.floor((x - r["least"]).cast("double") / width * (1 << BITS)).cast("int")

    placed = rows.join(stage(counted.join(ranges, "scope_id"), "ranges"), "scope_id").select(
        "scope_id", number.alias("block"), "src_item_id", "dst_item_id", "names", "label", "low", "high", F.zip_with("v", "ranges", scaled).alias("z"))

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        z = t["z"].combine_chunks().flatten().to_numpy().astype("<i4")
        weights = poisson_weights(t["src_item_id"].to_pylist(), t["dst_item_id"].to_pylist(), trees, seed)
        return pa.table({
            "scope_id": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int32()), "names": pa.array([t["names"][0].as_py()], pa.list_(pa.string())),
            "rows": pa.array([t.num_rows], pa.int32()), "z": [z.tobytes()], "label": [t["label"].to_numpy().astype("<i8").tobytes()],
            "weights": [weights.tobytes()], "low": [t["low"][0].as_py()], "high": [t["high"][0].as_py()]})

    return stage(placed.groupBy("scope_id", "block").applyInArrow(pack, BLOCK), "blocks")


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def names_of(blocks: DataFrame) -> DataFrame:
    """The names of each scope's features; all blocks of a scope hold the same."""
    return blocks.groupBy("scope_id").agg(F.min("names").alias("names"))


def to_blocks(blocks: DataFrame, per_scope: DataFrame) -> DataFrame:
    """``blocks`` with the columns of ``per_scope``, which goes to each block by itself: a scope of many blocks is no hot key."""
    return blocks.join(blocks.select("scope_id", "block").join(per_scope, "scope_id"), ["scope_id", "block"])
