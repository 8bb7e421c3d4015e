"""Session settings and shared staging tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kept for the life of the process so that the folder outlives lazy readers.
_local_root: tempfile.TemporaryDirectory | None = None
_run = uuid.uuid4().hex[:12]
_cleaning = False
# Folders of work whose staged tables go before the driver ends, innermost last.
_apart: list[str] = []

def build_session(app: str = "basketshift", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: spark-submit and
    adaptive execution choose them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # One batch has more generated classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent and Spark runs in
    this one machine's process, as in tests.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="basketshift-")
    return _local_root.name


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this run's folder under the staging root. The folder goes when the
    driver ends."""
    global _cleaning
    if not _cleaning:
        _cleaning = True
        atexit.register(_quietly, _folder_deleter(spark))
    return "/".join([staging_root(spark), f"basketshift-{_run}", *_apart[-1:], f"{label}-{uuid.uuid4().hex[:8]}"])


@contextmanager
def staging_apart(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end, whether it succeeds or not; nothing lazy may outlive it.

    Parts may be nested, but not run side by side in one driver: tables go to the part that began last.
    """
    name = f"part-{uuid.uuid4().hex[:8]}"
    _apart.append(name)
    try:
        yield
    finally:
        _apart.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/basketshift-{_run}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several consumers need one result: each reads only its columns, the
    lineage is cut at committed files, and the true size is known to the planner, so
    joins broadcast only what is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def _folder_deleter(spark: SparkSession):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/basketshift-{_run}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return lambda: files.delete(path, True)


def _quietly(action) -> None:
    try:
        action()
    except Exception:
        pass  # the JVM has gone first


def together(*steps: Callable[[], object]) -> None:
    """Run independent steps at the same time, each from its own driver thread."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(s) for s in steps]:
            done.result()


def require(spark: SparkSession) -> None:
    """Runtime settings that the plans count on, for sessions built elsewhere."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # A skewed join partition is split even where that costs one more exchange.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def small_batches(spark: SparkSession) -> None:
    """Rows that hold whole blocks reach Python a few at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def drop_staged(spark: SparkSession) -> None:
    """Delete what this run has staged so far."""
    _folder_deleter(spark)()
