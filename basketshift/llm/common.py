"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows and bytes of one Arrow batch: long texts must not gather in a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = "16m"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Hand this package's modules to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="basketshift-"), "basketshift_modules.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)


def prepare(spark: SparkSession) -> None:
    """Ship the package; settings that keep Python batches small and let skewed joins be split."""
    _ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of an input table; others, whatever their names, are left unread."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def text_of(column: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_hash(column: str = "text") -> Column:
    """Tells texts of one key apart."""
    return F.xxhash64(text_of(column))


def boxed(docs: DataFrame, *apart: str) -> DataFrame:
    """The columns ``apart``, and all others as one struct, so that whatever they are called no operator's names meet theirs."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in apart]
    box = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")
    return docs.select(*[F.col(f"`{c}`") for c in apart], box.alias("_boxed"))


def unboxed(found: DataFrame, docs: DataFrame, *apart: str) -> DataFrame:
    """The columns of ``docs``, in their order, of what was made of ``boxed`` rows."""
    return found.select(*[F.col(f"`{c}`") if c in apart else F.col("_boxed").getField(c).alias(c) for c in docs.columns])


def keep_rows(docs: DataFrame, kept: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``key`` and text_hash are in ``kept``; one of those that agree in both.

    The texts move once, by key and hash, which the final choice among repeated rows shares.
    """
    k, h, n = "_keep_key", "_keep_hash", "_keep_number"
    null = F.lit(-(1 << 63))
    keyed = boxed(docs, key, text).withColumns({k: F.coalesce(F.col(key).cast("bigint"), null), h: text_hash(text)})
    wanted = kept.select(F.coalesce(F.col(key).cast("bigint"), null).alias(k), F.col("text_hash").alias(h))
    found = keyed.join(wanted, [k, h], "left_semi")
    return unboxed(found.withColumn(n, F.row_number().over(Window.partitionBy(k, h).orderBy(F.lit(0)))).where(F.col(n) == 1), docs, key, text)


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """How many partitions hold ``rows`` at ``per_part`` each."""
    return max(least, -(-rows // per_part))


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]], schema: str) -> DataFrame:
    """Apply ``rows`` to the batches of each partition, as dictionaries of Python lists.

    ``rows`` gets an iterator over one partition's batches and yields batches of ``schema``.
    """
    target = spark_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for out in rows({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches):
                yield pa.RecordBatch.from_pydict(out, schema=target)
        finally:
            # The worker lives on beside those of later stages; Arrow would keep what this task has freed.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def spark_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
