"""Vector codes by ball k-means.

Vectors of whole numbers are cut into parts; each part position has a codebook, fitted by rounds of k-means. In a round the parts that
an entry holds are a ball around it. Only entries within twice its radius can take parts from it; parts closer than half the distance to the nearest
of them, the stable core, stay without further work; the others lie in rings between half distances and are held against the
neighbours up to their ring. All comparisons are in whole numbers, so results are those of a full search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import prepare, spark_schema
from basketshift.session import stage

# Rows that a task works on at once: balls are those of such a block, smaller than those of all rows, and as exact.
BLOCK = 16384


@dataclass(frozen=True)
class CodeParams:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    # Components become floor(scale * x).
    scale: int = 4096
    # Whole components must be below 2 ** most_bits in size, so that squared distances of a vector fit into 64 bits.
    most_bits: int = 27


def whole_vectors(vectors: DataFrame, params: CodeParams, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and the whole components (32-bit, as bytes) of the vectors without nulls and non-finite components."""
    values = F.col(vector).cast("array<double>")
    finite = values.isNotNull() & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = vectors.where(F.coalesce(finite, F.lit(False))).select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).alias("label"), values.alias("x"))
    most = 1 << params.most_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x")
            whole = np.floor(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * params.scale)
            if np.abs(whole).max(initial=0) >= most:
                raise ValueError(f"a component is not below {most} when multiplied by {params.scale}")
            ends = np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            whole = whole.astype("<i4")
            raw = [whole[s:e].tobytes() for s, e in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(raw, pa.binary())], names=["vec_id", "label", "whole"])

    kind = named.schema["label"].dataType.simpleString()
    return named.mapInArrow(run, f"vec_id bigint, label {kind}, whole binary")


def square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(-1)


def reassign(x: np.ndarray, codes: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part (ties: the lowest), and its squared distance, from the entries that held them before.

    ``moved`` tells which entries differ from those that ``codes`` were found with. It must be all True for codes that were not.
    """
    held, codes, own = codes, codes.copy(), square(x - book[codes])
    best = own.copy()
    apart = square(book[:, None] - book[None])
    for i in np.unique(held):
        members = np.nonzero(held == i)[0]
        # Twice the radius of the ball: d(i, j) <= 2 r, in squares.
        near = np.nonzero(apart[i] <= 4 * own[members].max())[0]
        near = near[near != i]
        if not len(near) or not (moved[i] or moved[near].any()):
            continue
        near = near[np.argsort(apart[i][near], kind="stable")]
        # The ring of a part: how many neighbours have half their distance within the part's own. 0 is the stable core.
        ring = np.searchsorted(apart[i][near], 4 * own[members], side="right")
        new = np.full(len(members), i)
        least = own[members]
        for n, j in enumerate(near):
            at = np.nonzero(ring > n)[0]
            d = square(x[members[at]] - book[j])
            wins = (d < least[at]) | ((d == least[at]) & (j < new[at]))
            new[at[wins]], least[at[wins]] = j, d[wins]
        codes[members], best[members] = new, least
    return codes, best


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BLOCK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _whole(column: pa.ChunkedArray, params: CodeParams, width: int) -> np.ndarray:
    """rows x parts x components."""
    rows = column.to_pylist()
    if any(len(r) != 4 * params.parts * width for r in rows):
        raise ValueError("vectors differ in length")
    return np.frombuffer(b"".join(rows), dtype="<i4").astype(np.int64).reshape(len(rows), params.parts, width)


def assigned(coded: DataFrame, books: np.ndarray, moved: np.ndarray, params: CodeParams) -> DataFrame:
    """``coded`` with the codes (one byte for each part) and the error under the given codebooks (part x entry x component)."""
    target = spark_schema(coded.sparkSession, schema := ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in coded.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            x = _whole(t["whole"], params, books.shape[2])
            codes = np.frombuffer(b"".join(t["codes"].to_pylist()), dtype=np.uint8).reshape(len(x), params.parts).astype(np.int64)
            out, error = np.zeros_like(codes, dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
            for p in range(params.parts):
                found, d = reassign(x[:, p], codes[:, p], books[p], moved[p])
                out[:, p] = found
                error += d
            new = {"codes": pa.array([r.tobytes() for r in out], pa.binary()), "error": pa.array(error)}
            yield from pa.Table.from_arrays([new.get(n, t[n]) for n in target.names], schema=target).combine_chunks().to_batches()

    return coded.mapInArrow(run, schema)


def _sums(coded: DataFrame, params: CodeParams, width: int, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and counts of the parts of every entry: one row per component of the codebooks reaches the driver."""
    size = entries * (width + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((params.parts, entries, width + 1), dtype=np.int64)
        for t in _blocks(batches):
            x = _whole(t["whole"], params, width)
            codes = np.frombuffer(b"".join(t["codes"].to_pylist()), dtype=np.uint8).reshape(len(x), params.parts)
            for p in range(params.parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, start = np.unique(codes[order, p], return_index=True)
                total[p, used, :width] += np.add.reduceat(x[order, p], start, axis=0)
                total[p, used, width] += np.diff([*start, len(x)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(params.parts * size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "total"])

    found = coded.select("whole", "codes").mapInArrow(run, "cell int, total bigint").groupBy("cell").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(params.parts * size, dtype=np.int64)
    for r in found:
        total[r["cell"]] = r["total"]
    total = total.reshape(params.parts, entries, width + 1)
    return total[:, :, :width], total[:, :, width]


def book_hash(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, params: CodeParams = CodeParams(), key: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, codes (a byte for each part) and error of every kept row, and the codebooks (part x entry x component).

    Rows whose vector is null or holds a null or non-finite component are left out. A codebook starts as the parts of the
    ``params.entries`` smallest ids (null ids last; equal ids by their components), of fewer where fewer rows are kept. Repeated rows
    count each time; an empty table gives no rows and empty codebooks; other columns are not read. Vectors must have one
    length, a multiple of ``params.parts``; other lengths, and components of 2 ** ``params.most_bits`` and above after scaling, raise a
    ValueError rather than give wrong distances.

    Each round reads the vectors once to assign them and once to add them up; codebooks and sums, whose size does
    not depend on the rows, are all that the driver holds.
    """
    prepare(vectors.sparkSession)
    whole = stage(whole_vectors(vectors, params, key, vector, label), "vectors")
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(params.entries).select("whole").collect()
    lengths = {len(r["whole"]) for r in first} or {0}
    if len(lengths) > 1 or (length := lengths.pop() // 4) % params.parts:
        raise ValueError("vectors differ in length, or cannot be cut into equal parts")
    width = length // params.parts
    books = np.array([np.frombuffer(r["whole"], dtype="<i4") for r in first], dtype=np.int64).reshape(len(first), params.parts, width).transpose(1, 0, 2).copy()
    coded = whole.select("vec_id", "label", "whole", F.lit(bytes(params.parts)).alias("codes"), F.lit(0).cast("bigint").alias("error"))
    if not first:
        return coded.drop("whole"), books
    moved = np.ones(books.shape[:2], dtype=bool)
    for _ in range(params.rounds):
        coded = stage(assigned(coded, books, moved, params), "codes")
        sums, counts = _sums(coded, params, width, len(first))
        new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        moved, books = (new != books).any(2), new
    return stage(assigned(coded, books, moved, params), "codes").drop("whole"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over rows of equal label, nulls together. Sums per label are joined back, not rows gathered."""
    known, null = F.coalesce(F.col("label").cast("string"), F.lit("")), F.col("label").isNull()
    keyed = coded.withColumns({"_known": known, "_null": null})
    totals = keyed.groupBy("_known", "_null").agg(F.sum("error").alias("label_error"))
    return keyed.join(totals, ["_known", "_null"]).drop("_known", "_null")


def statement(params: CodeParams = CodeParams()) -> str:
    """DuckDB SQL for the query over ``embeddings``: every round as a full search."""
    parts = params.parts
    steps = [f"""
kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor({params.scale} * cast(x as double)) as bigint)) as x,
                row_number() over (order by vec_id) as r
         from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select vec_id, label, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] as x, r from kept, (select unnest(range({parts})) as p)),
book0 as (select p, r - 1 as e, x from parts where r <= {params.entries})"""]
    for t in range(params.rounds + 1):
        # Distances are ordered with ties to the lower entry.
        steps.append(f"""
near{t} as (select vec_id, parts.p, min(list_sum(list_transform(list_zip(parts.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {params.entries} + e) as best
           from parts join book{t} b on parts.p = b.p group by vec_id, parts.p),
code{t} as (select vec_id, p, best % {params.entries} as e, best // {params.entries} as d from near{t})""")
        if t < params.rounds:
            steps.append(f"""
mean{t} as (select p, e, i, cast(sum(x[i]) as bigint) as s, count(*) as n
           from (select parts.p, e, x, unnest(range(1, len(x) + 1)) as i from parts join code{t} using (vec_id, p)) group by p, e, i),
new{t} as (select p, e, list((s - ((s % n) + n) % n) // n order by i) as x from mean{t} group by p, e),
book{t + 1} as (select b.p, b.e, coalesce(n.x, b.x) as x from book{t} b left join new{t} n on b.p = n.p and b.e = n.e)""")
    last = params.rounds
    return "with " + ",".join(steps) + f""",
coded as (select vec_id, string_agg(printf('%02x', cast(e as bigint)), '' order by p) as code, cast(sum(d) as bigint) as error from code{last} group by vec_id),
labelled as (select vec_id, label, code, error from coded join kept using (vec_id))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(v as varchar), ',' order by p, e, i)) from (select p, e, unnest(x) as v, unnest(range(len(x))) as i from book{last})) as codebooks_sha256
from labelled
"""
