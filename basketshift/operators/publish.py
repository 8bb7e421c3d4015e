"""Sinks: tables partitioned by (dt, cid3), replaced one partition at a time and readable at any moment.

A published table is a manifest: a small file that names, for each partition, the folder that holds its rows. New rows go to a
fresh version folder; then the manifest with the next number takes their place by one rename. Readers resolve the highest
number, so whenever a writer is stopped they see the partitions as they were or as they are to be, never a gap. Version folders
that no recent manifest names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = ["dt", "cid3"]
MANIFESTS, VERSIONS = "_manifests", "_versions"

# Result tables loaded per category; cdt is loaded with display names.
RESULT_TABLES = ("scope", "switching_prob", "sku_in_scope", "spendswitch", "cdt", "predicted", "assortment", "impact")
SOURCE_OF = {"cdt": "cdt_cn"}

Work = Iterable[tuple[str, str]]


class Files:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name if "/" in name else f"{self.path}/{name}")

    def names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.path}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Puts a whole file in place at once. False if there is one of that name."""
        draft, target = self._path(f"{self.path}/_draft-{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        self.fs.mkdirs(target.getParent())
        stream = self.fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        # A rename onto an existing file fails on HDFS; local file systems would replace it.
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.path}/{name}"), True)


def _numbers(files: Files) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in files.names(MANIFESTS) if n[0].isdigit())


def _entries(files: Files, number: int) -> dict[tuple[str, str], str]:
    """Folder of each partition in one manifest: metadata, of the size of the list of partitions."""
    lines = files.read(f"{MANIFESTS}/{number:010d}.jsonl").splitlines()
    return {(e["dt"], e["cid3"]): e["folder"] for e in map(json.loads, lines)}


def manifest(spark: SparkSession, path: str) -> dict[tuple[str, str], str] | None:
    """The current manifest; None where the path is not a published table."""
    files = Files(spark, path)
    numbers = _numbers(files)
    return _entries(files, numbers[-1]) if numbers else None


@dataclass
class Prepared:
    """Rows that are written but not yet visible: ``paths`` are the tables that will show them."""

    paths: Sequence[str]
    found: dict[tuple[str, str], str]
    # Partitions that go if the new rows have none for them.
    work: set[tuple[str, str]] = field(default_factory=set)


def prepare(df: DataFrame, paths: Sequence[str], work: Work = ()) -> Prepared:
    """Writes ``df`` (with dt and cid3) to a version folder of the last of ``paths``, which all of them will show."""
    spark, home = df.sparkSession, paths[-1].rstrip("/")
    version = f"{home}/{VERSIONS}/{uuid.uuid4().hex}"
    # Partition columns stay in the files too, so that partitions of many versions are one read.
    (df.withColumns({"_dt": F.col("dt"), "_cid3": F.col("cid3")}).write.partitionBy("_dt", "_cid3").parquet(version))
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    files, found = Files(spark, version), {}
    for day in files.names("."):
        if day.startswith("_dt="):
            for cid3 in files.names(day):
                if cid3.startswith("_cid3="):
                    found[plain(day[4:]), plain(cid3[6:])] = f"{version}/{day}/{cid3}"
    return Prepared(list(paths), found, set(work))


def commit(spark: SparkSession, *prepared: Prepared) -> None:
    """Makes prepared rows visible, one rename for each table. If another writer has come first, its partitions are taken over."""
    for p in prepared:
        for path in p.paths:
            files = Files(spark, path)
            while True:
                numbers = _numbers(files)
                entries = _entries(files, numbers[-1]) if numbers else {}
                entries = {k: f for k, f in entries.items() if k not in p.work} | p.found
                text = "".join(json.dumps({"dt": dt, "cid3": cid3, "folder": f}) + "\n" for (dt, cid3), f in sorted(entries.items()))
                if files.create(f"{MANIFESTS}/{(numbers[-1] if numbers else 0) + 1:010d}.jsonl", text):
                    break


def vacuum(spark: SparkSession, paths: Sequence[str], keep: int = 2) -> None:
    """Removes versions that none of the last ``keep`` manifests of ``paths``, the tables that show them, names, and older manifests.

    Call it when no writer is between ``prepare`` and ``commit``. A reader that resolved one of the kept manifests is not disturbed.
    """
    used: set[str] = set()
    for path in paths:
        files = Files(spark, path)
        numbers = _numbers(files)
        for n in numbers[:-keep]:
            files.delete(f"{MANIFESTS}/{n:010d}.jsonl")
        for n in numbers[-keep:]:
            used |= {f.split(f"/{VERSIONS}/")[1].split("/")[0] for f in _entries(files, n).values()}
    for path in paths:
        files = Files(spark, path)
        for version in files.names(VERSIONS):
            if version not in used:
                files.delete(f"{VERSIONS}/{version}")


def overwrite_partitions(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace the (dt, cid3) partitions of a plain folder that ``df`` holds; others stay. For the control table, which a stream watches."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION)
     .format(file_format).save(path))


def read_partitions(spark: SparkSession, path: str, schema: str, dt: str | Sequence[str] | None = None, cid3: Sequence[str] | None = None,
                    file_format: str = "parquet") -> DataFrame:
    """A published table, or a plain partitioned folder. ``dt`` and ``cid3`` choose partitions before any file is listed."""
    entries = manifest(spark, path)
    want = f"{schema}, dt string, cid3 string"
    days = [dt] if isinstance(dt, str) else dt
    if entries is None:
        df = spark.read.schema(want).format(file_format).load(path)
        if days is not None:
            df = df.where(F.col("dt").isin(*days))
        return df if cid3 is None else df.where(F.col("cid3").isin(*cid3))
    chosen = sorted(f for (d, c), f in entries.items() if (days is None or d in days) and (cid3 is None or c in cid3))
    if not chosen:
        return spark.createDataFrame([], want)
    return spark.read.schema(want).option("recursiveFileLookup", "true").parquet(*chosen)


def with_partition(df: DataFrame, day: date | str) -> DataFrame:
    """Adds dt, and cid3 taken from the third part of the scope id."""
    return df.withColumns({"dt": F.lit(str(day)), "cid3": F.split("scope_id", "_")[2]})


def category_of(scope_id: str) -> str:
    """The cid3 that ``with_partition`` gives a scope."""
    return scope_id.split("_")[2]


def publish(df: DataFrame, tmp: str, pre: str, final: str, schema: str, work: Work = ()) -> DataFrame:
    """Load once, then show it as the temporary, the preview and the final table. Returns the partitions written.

    ``df`` has dt and cid3. Partitions of ``work`` that it has no rows for go with the same step.
    """
    spark = df.sparkSession
    ready = prepare(df, [tmp, pre, final], work)
    commit(spark, ready)
    if not ready.found:
        return spark.createDataFrame([], f"{schema}, dt string, cid3 string")
    return spark.read.schema(f"{schema}, dt string, cid3 string").option("recursiveFileLookup", "true").parquet(*ready.found.values())


def publish_status(status: DataFrame, tmp: str, finish: str, schema: str) -> None:
    commit(status.sparkSession, prepare(status, [tmp, finish]))


def prepare_results(outputs: dict[str, list[DataFrame]], day: date, root: str, categories: Sequence[str] = ()) -> dict[str, Prepared]:
    """Each result table as the union of its scopes' outputs, written but not yet visible."""
    ready = {}
    for table in RESULT_TABLES:
        parts = outputs.get(SOURCE_OF.get(table, table))
        if not parts:
            continue
        df = parts[0]
        for more in parts[1:]:
            df = df.unionByName(more)
        own = "scope_id" in df.columns
        df = with_partition(df if own else df.withColumn("scope_id", F.col("id")), day)
        ready[table] = prepare(df if own else df.drop("scope_id"), [f"{root}/{table}"], [(str(day), c) for c in categories])
    return ready


def assemble(outputs: dict[str, list[DataFrame]], day: date, root: str, categories: Sequence[str] = ()) -> list[str]:
    """Union the scopes' outputs per table and load them by category. Returns the loaded tables.

    Partitions of the day's ``categories`` without rows go with the same step.
    """
    ready = prepare_results(outputs, day, root, categories)
    for table, p in ready.items():
        commit(outputs[SOURCE_OF.get(table, table)][0].sparkSession, p)
    return list(ready)


def mark_done(control: str, work: DataFrame) -> None:
    """Set the status of the given (dt, cid3) to 1. Call it after their results are published."""
    overwrite_partitions(work.select(F.lit("1").alias("status"), *PARTITION), control)


def publish_day(end: date) -> date:
    return end + timedelta(days=1)
