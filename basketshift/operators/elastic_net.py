"""Elastic nets of all scopes in one job.

One aggregation gives every scope its Gram matrix: the sums of all products of two of its columns. What follows needs no row: each
scope's coefficients come from coordinate descent on its own matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.operators.blocks import BITS, Block, blocks_of, names_of


@dataclass(frozen=True)
class NetParams:
    # Of columns of unit variance: the penalty, and the share of it that is on absolute values.
    penalty: float = 0.01
    absolute: float = 0.5
    sweeps: int = 100


def gram_matrices(blocks: DataFrame) -> DataFrame:
    """scope_id, i, j and total: the sum of the products of columns i <= j. Column 0 is 1, the last one the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks_of(batches):
            b = Block.of(row)
            label = ((b.label - b.low) / float(b.high - b.low + 1) * (1 << BITS)).astype(np.int64)
            x = np.column_stack([np.ones(len(label), dtype=np.int64), b.z, label])
            # Products are below 2 ** 40 and blocks bounded, so 64 bits hold a block's sums.
            i, j = np.triu_indices(x.shape[1])
            total = (x.T @ x)[i, j]
            yield pa.RecordBatch.from_arrays([pa.array([row["scope_id"]] * len(i)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(total)], names=["scope_id", "i", "j", "total"])

    sums = blocks.mapInArrow(run, "scope_id string, i int, j int, total bigint")
    return sums.groupBy("scope_id", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def correlations(gram: dict[tuple[int, int], int], columns: int) -> np.ndarray:
    """Correlations of columns 1 to ``columns`` - 1, the label last; 0 with a column that does not vary."""
    n = gram[0, 0]
    out = np.zeros((columns - 1, columns - 1))
    spread = [math.sqrt(max(0, n * gram[i, i] - gram[0, i] ** 2)) for i in range(1, columns)]
    for i in range(1, columns):
        for j in range(i, columns):
            if spread[i - 1] and spread[j - 1]:
                out[i - 1, j - 1] = out[j - 1, i - 1] = (n * gram[i, j] - gram[0, i] * gram[0, j]) / spread[i - 1] / spread[j - 1]
    return out


def descend(r: np.ndarray, p: NetParams) -> np.ndarray:
    """Coefficients of the features, all of unit variance, from their correlations and those with the label, the last column."""
    m = len(r) - 1
    beta = np.zeros(m)
    for _ in range(p.sweeps):
        for j in range(m):
            rest = r[j, m] - r[j, :m] @ beta + r[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - p.penalty * p.absolute, 0.0) / (1 + p.penalty * (1 - p.absolute)) if r[j, j] else 0.0
    return beta


def importances(blocks: DataFrame, p: NetParams = NetParams()) -> DataFrame:
    """scope_id, name and weight, the absolute coefficient at unit variance, of every feature."""
    cells = gram_matrices(blocks).groupBy("scope_id").agg(F.collect_list(F.struct("i", "j", F.col("total").cast("string").alias("total"))).alias("cells"))
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in blocks_of(batches):
            gram = {(c["i"], c["j"]): int(c["total"]) for c in row["cells"]}
            beta = descend(correlations(gram, len(row["names"]) + 2), p)
            yield pa.RecordBatch.from_pydict({"scope_id": [row["scope_id"]] * len(beta), "name": row["names"], "weight": np.abs(beta).tolist()})

    # One row per scope, of a size that its features alone decide.
    return names_of(blocks).join(cells, "scope_id").mapInArrow(solve, "scope_id string, name string, weight double")
