"""Shards by histogram sort.

Rows are ordered by (hash of the text, key, row number). The borders of the shards are found by counting:
every round counts the exact bytes below some probes in every partition, adds the counts up, and
narrows each border's interval to the two probes around its target. When all borders are close
enough, or exact, the rows are exchanged once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from basketshift.llm.common import boxed, parts_for, prepare, text_of
from basketshift.session import stage

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class SortParams:
    shards: int = 24
    # How far the bytes below a border may be from their target, as a share of a shard.
    tolerance: float = 0.001
    # Probes of all borders in one round: the driver adds up one count for each.
    probes: int = 1 << 17
    # Bytes aimed at in one task of the exchange; a shard is cut into that many parts.
    part_bytes: int = 64 << 20


Place = tuple[int, int, int]


def _below(places: list[Place], h: np.ndarray, k: np.ndarray, r: np.ndarray) -> np.ndarray:
    """How many of the sorted places (hash, key, row number) are at or below each (h, k, r)."""
    heads = np.array([p[0] for p in places], dtype=np.int64)
    at, last = np.searchsorted(heads, h, side="left"), np.searchsorted(heads, h, side="right")
    inside = np.nonzero(last > at)[0]
    if len(inside):
        # Rows of a hash at which there are several places: those of one hash share their list.
        group = at[inside]
        for s in np.unique(group):
            rows = inside[group == s]
            mine = places[s:last[rows[0]]]
            keys = np.array([p[1] for p in mine], dtype=np.int64)
            first, behind = np.searchsorted(keys, k[rows], side="left"), np.searchsorted(keys, k[rows], side="right")
            for f in np.unique(first[behind > first]):
                same = (first == f) & (behind > first)
                numbers = np.array([p[2] for p in mine[f:behind[same][0]]], dtype=np.int64)
                first[same] += np.searchsorted(numbers, r[rows[same]], side="right")
            at[rows] += first
    return at


def _counts(sizes: DataFrame, probes: list[Place]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe (h, k, r), a sorted list. One narrow pass, sums per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, dtype=np.int64), np.zeros(len(probes) + 1, dtype=np.int64)
        for b in batches:
            at = _below(probes, *(b.column(c).to_numpy() for c in ("h", "k", "r")))
            np.add.at(size, at, b.column("size").to_numpy())
            np.add.at(rows, at, 1)
        full = np.nonzero(rows)[0]
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(size[full]), pa.array(rows[full])], names=["probe", "bytes", "rows"])

    found = sizes.select("h", "k", "r", "size").mapInArrow(count, "probe int, bytes bigint, rows bigint").groupBy("probe").agg(F.sum("bytes"), F.sum("rows")).collect()
    size, rows = np.zeros(len(probes), dtype=np.int64), np.zeros(len(probes), dtype=np.int64)
    for probe, b, n in found:
        if probe < len(probes):
            size[probe], rows[probe] = b, n
    return np.cumsum(size), np.cumsum(rows)


@dataclass
class _Border:
    """An interval of keys that holds the place where the bytes below reach ``target``."""

    target: int
    low: Place = (LOW, LOW, LOW)
    high: Place = (HIGH, HIGH, HIGH)
    low_bytes: int = 0
    low_rows: int = 0
    high_bytes: int = 0
    high_rows: int = 0
    done: tuple[Place, int, int] | None = None

    def settle(self, slack: int) -> None:
        ends = [(abs(self.low_bytes - self.target), self.low, self.low_bytes, self.low_rows),
                (abs(self.high_bytes - self.target), self.high, self.high_bytes, self.high_rows)]
        off, at, size, rows = min(ends)
        if off <= slack or self.high_rows - self.low_rows <= 1 or not self.probes(2):
            self.done = (at, size, rows)

    def probes(self, n: int) -> list[Place]:
        """Places inside the interval. Hashes are halved first, so that equal texts stay together; only when a single
        hash is left are its rows told apart by key, and only those of one key by their numbers."""
        (lo, lo_k, lo_r), (hi, hi_k, hi_r) = self.low, self.high
        if hi - lo > 1:
            return sorted({(lo + (hi - lo) * i // n, LOW, LOW) for i in range(1, n)} - {self.low, self.high})
        # All rows left have hash ``lo``: keys from lo_k to hi_k (to the end if the upper end is the next hash).
        top, top_r = (hi_k, hi_r) if hi == lo else (HIGH, HIGH)
        if top - lo_k > 1:
            return sorted({(lo, lo_k + (top - lo_k) * i // n, LOW) for i in range(1, n)} - {self.low, self.high})
        end = top_r if top == lo_k else HIGH
        return sorted({(lo, lo_k, lo_r + (end - lo_r) * i // n) for i in range(1, n)} - {self.low, self.high})


def borders(sizes: DataFrame, targets: list[int], total: tuple[int, int], slack: int, probes: int) -> list[tuple[Place, int, int]]:
    """For each target the border key, and exactly how many bytes and rows lie below it.

    ``sizes`` has h, k, r and size. A round puts 2 to 2048 probes into each open interval, ``probes`` in all
    at most if there are fewer than half as many borders.
    """
    open_ = [_Border(t, high_bytes=total[0], high_rows=total[1]) for t in targets]
    everyone = open_
    for b in open_:
        b.settle(slack)
    while open_ := [b for b in open_ if b.done is None]:
        each = min(2048, max(2, probes // len(open_)))
        places = sorted({p for b in open_ for p in b.probes(each)})
        below, rows = _counts(sizes, places)
        for b in open_:
            for p, size, n in zip(places, below.tolist(), rows.tolist(), strict=True):
                if b.low < p < b.high:
                    if size <= b.target:
                        b.low, b.low_bytes, b.low_rows = p, size, n
                    else:
                        b.high, b.high_bytes, b.high_rows = p, size, n
                        break
            b.settle(slack)
    return [b.done for b in everyone]


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none), and 8 for the row."""
    return F.octet_length(text_of(text)).cast("bigint") + 8


def shard(docs: DataFrame, params: SortParams = SortParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with size, shard (0 to ``params.shards`` - 1) and slot (from 0, gapless in each shard).

    Law: sizes near equal. Every border's bytes are within ``params.tolerance`` of a shard of their
    target, or as near as whole rows allow. Rows of equal texts lie side by side in one shard unless
    a border has to cut them, because moving it past them would miss the tolerance. Null
    keys come first among equal texts; rows that agree in text and key are told apart by a number that they get when they are written,
    so any number of them can be cut. A null text has size 8. An empty table gives an empty result. Columns of ``docs`` named like those added are replaced;
    all others, whatever they are called, are kept.

    The rows are written once with their numbers and then exchanged once, to parts of about ``params.part_bytes`` each; the rounds
    read 32 bytes a row of what was written.
    """
    spark = docs.sparkSession
    prepare(spark)
    named = docs.drop("size", "shard", "slot")
    hashed = F.xxhash64(text_of(text), F.lit("shard"))
    ident = F.coalesce(F.col(key).cast("bigint"), F.lit(LOW))
    rows_ = stage(boxed(named, key, text).withColumns({"_h": hashed, "_k": ident, "_r": F.monotonically_increasing_id(), "_size": text_size(text)}), "numbered")
    sizes = rows_.select(F.col("_h").alias("h"), F.col("_k").alias("k"), F.col("_r").alias("r"), F.col("_size").alias("size"))
    rows, total = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    per_shard = max(1, parts_for(total // params.shards + 1, params.part_bytes, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // params.shards)))
    parts = params.shards * per_shard
    slack = int(total / params.shards * params.tolerance)
    cuts = borders(sizes, [total * i // parts for i in range(1, parts)], (total, rows), slack, params.probes)

    # A part's number is the number of borders at or below the row. It decides the shard, and the rows
    # of that shard in parts before it.
    rows_below = np.array([0, *(c[2] for c in cuts)], dtype=np.int64)
    first_part = np.arange(parts) // per_shard * per_shard
    offsets = rows_below - rows_below[first_part]
    places = [c[0] for c in cuts]

    def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = _below(places, *(b.column(c).to_numpy() for c in ("_h", "_k", "_r")))
            yield (b.append_column("_part", pa.array(part.astype("int32"))).append_column("shard", pa.array((part // per_shard).astype("int32")))
                   .append_column("_offset", pa.array(offsets[part])))

    schema = StructType([*rows_.schema.fields]).add("_part", IntegerType()).add("shard", IntegerType()).add("_offset", LongType())
    within = Window.partitionBy("_part").orderBy("_h", "_k", "_r")
    dealt = rows_.mapInArrow(part_of, schema).withColumn("slot", F.col("_offset") + F.row_number().over(within) - 1)
    kept = [F.col(f"`{c}`") if c in (key, text) else F.col("_boxed").getField(c).alias(c) for c in named.columns]
    return dealt.select(*kept, F.col("_size").alias("size"), "shard", "slot")
