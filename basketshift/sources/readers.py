"""Scans. Predicates and column lists reach the file readers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketshift.functions import columns as C
from basketshift.sources import schemas

# Event codes that count as interest in the click log, and the number
# of days read before the end day.
INTEREST_CODES = ("1", "13", "8", "311210")
LOG_DAYS = 11


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, header: bool = True) -> DataFrame:
    """Tab-separated text: no quoting, null tokens, rows without any value dropped.

    Columns are read as text and cast to ``schema``, so that a null token in a number
    column is null instead of an error.
    """
    want = schemas.struct(schema) if isinstance(schema, str) else schema
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in want])
    df = spark.read.schema(raw).csv(path, sep="\t", header=header, quote="", enforceSchema=False if header else True)
    cols = [F.when(~F.col(f.name).isin(*C.NULL_TOKENS), F.col(f.name)).cast(f.dataType).alias(f.name) for f in want]
    return df.select(*cols).dropna("all")


def write_tsv(df: DataFrame, path: str, header: bool) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=header, quote="", nullValue="", emptyValue="")


def partition_scan(table: DataFrame, *, dt_op: str = "none", dt: date | str | None = None, dt_from: date | str | None = None,
                   dt_col: str = "dt", key_col: str | None = None, keys: Sequence | None = None,
                   extra: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A dated, keyed extract of a partitioned table.

    ``dt_op`` is one of ``= <= < range none``; ``dt`` may be a day or a partition tag. Covers assortment, curated attributes,
    competitor match, GMV, brand mapping, profit and loss, brand dictionary, forecast
    attributes, past assortment and category-role tables, which differ only here.
    """
    day = F.col(dt_col)
    rules = {
        "=": lambda: day == F.lit(dt),
        "<=": lambda: day <= F.lit(dt),
        "<": lambda: day < F.lit(dt),
        "range": lambda: day.between(F.lit(dt_from), F.lit(dt)),
        "none": lambda: None,
    }
    if dt_op not in rules:
        raise ValueError(f"unknown dt_op {dt_op!r}")
    rule = rules[dt_op]()
    df = table if rule is None else table.where(rule)
    if keys is not None:
        df = df.where(F.col(key_col).isin(*keys))
    if extra is not None:
        df = df.where(extra)
    return df.select(*columns) if columns else df


def order_scan(lines: DataFrame, start: date, end: date, cid3: Sequence[str] | None = None,
               day: str = "sale_ord_dt", valid_only: bool = True) -> DataFrame:
    """Valid order lines of the given categories with start <= day <= end."""
    df = lines.where(F.col(day).between(F.lit(start), F.lit(end)))
    if valid_only:
        df = df.where(F.col("sale_ord_valid_flag") == 1)
    return df if cid3 is None else df.where(F.col("cid3").isin(*cid3))


def sku_scan(skus: DataFrame, cid3: Sequence[str] | None = None, dt: str | None = None, code: str = "data_type") -> DataFrame:
    """Sku master on its snapshot day, with the seller type derived from the code column."""
    if dt is not None:
        skus = skus.where(F.col("dt") == dt)
    if cid3 is not None:
        skus = skus.where(F.col("cid3").isin(*cid3))
    return skus.withColumn("sku_type", C.sku_type(code))


def ext_attr_scan(attrs: DataFrame, dt: str, cid3: Sequence[str]) -> DataFrame:
    """Extended attributes of one day, data type 2 left out."""
    return partition_scan(attrs, dt_op="=", dt=dt, key_col="cate_id", keys=cid3, extra=F.col("data_type") != 2,
                          columns=["data_type", "item_sku_id", "com_attr_name", "com_attr_value_name", "cate_id", "dt"])


def view_scan(log: DataFrame, end: date, codes: Sequence[str] = INTEREST_CODES, cid3: Sequence[str] | None = None) -> DataFrame:
    """Item views in the 11 days before ``end`` (end left out).

    The session key joins session and event code, so only views of one kind pair up.
    """
    df = log.where((F.col("dt") >= F.lit(end - timedelta(days=LOG_DAYS))) & (F.col("dt") < F.lit(end)))
    df = df.where(F.col("session_id").isNotNull() & F.col("bs").isin(*codes))
    if cid3 is not None:
        df = df.where(F.col("item_third_cate_id").isin(*cid3))
    return df.select("item_sku_id", "user_log_acct", F.to_date("request_tm").alias("request_dt"),
                     F.concat("session_id", "bs").alias("session_id"))


def pending_scopes(control: DataFrame) -> DataFrame:
    """Work list: loaded but not yet computed (dt, cid3)."""
    return control.where(F.col("status") == "0").select("dt", "cid3")
