"""Loading tab-separated inputs: rows that fit their schema, and a side table of those that do not."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.functions import columns as C
from basketshift.plans.batch import BatchInputs
from basketshift.sources import schemas
from basketshift.sources.readers import sku_scan

REJECTS = "source string, file string, line string, reason string"


@dataclass
class Loaded:
    """``rows`` conform to the schema. ``rejects`` has source, file, line and reason; ``counts`` rows, empty and rejected lines per file."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def load_tsv(spark: SparkSession, path: str | Sequence[str], spec: str, source: str = "", required: Sequence[str] = ()) -> Loaded:
    """Lines of tab-separated files with a header line, against ``spec``.

    Null tokens are null, and lines without any value are empty and dropped. A line is rejected, with its first reason, if it has
    another number of columns than the schema, a value that its type cannot take, or no value in a ``required`` column. Files are read
    once for each of the three results that is asked for; nothing is shuffled but the counts.
    """
    want = schemas.struct(spec)
    names = [f.name for f in want]
    # Values and what is known of a line apart, so that a column may have any name.
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"), F.split("value", "\t").alias("parts"))
    lines = lines.where(F.col("line") != "\t".join(names))
    text = [C.null_tokens(F.try_element_at("parts", F.lit(i + 1))) for i in range(len(names))]
    read = lines.withColumns({"text": F.array(*text), "row": F.struct(*[t.try_cast(f.dataType).alias(f.name) for t, f in zip(text, want, strict=True)])})

    def missing(name: str):
        return F.col("row").getField(name).isNull()

    n = F.size("parts")
    wrong = F.when(n != len(names), F.concat(F.lit("columns: "), n.cast("string")))
    for i, f in enumerate(want):
        wrong = wrong.when(F.col("text")[i].isNotNull() & missing(f.name), F.lit(f"type: {f.name}"))
    for name in required:
        wrong = wrong.when(missing(name), F.lit(f"missing: {name}"))
    empty = F.forall("text", lambda x: x.isNull()) & (n <= len(names))
    judged = read.withColumn("empty", empty).withColumn("reason", F.when(~F.col("empty"), wrong))
    good = ~F.col("empty") & F.col("reason").isNull()
    rows = judged.where(good).select("row.*")
    rejects = judged.where("reason is not null").select(F.lit(source).alias("source"), "file", "line", "reason")
    counts = judged.groupBy(F.lit(source).alias("source"), "file").agg(
        F.count_if(good).alias("rows"), F.count_if("empty").alias("empty"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    return Loaded(schemas.conform(rows, spec), rejects, counts)


# The inputs of a batch: folder, schema, and the columns without which a row says nothing.
BATCH_TABLES = {
    "order_lines": (schemas.ORDER_LINES + ", sale_ord_valid_flag int, cid3 string", ("parent_sale_ord_id", "item_sku_id", "sale_ord_tm")),
    "sku_master": ("item_sku_id string, sku_name string, cid3 string, data_type int", ("item_sku_id", "cid3")),
    "category_tree": (schemas.CATEGORY_TREE, ("item_third_cate_cd",)),
    "attributes": (schemas.ATTRIBUTES, ("sku_id", "attr_name")),
    "brand_dict": (schemas.BRAND_DICT, ("brand_id",)),
    "fourth_category": ("sku_id string, cid3 string, attr_value string", ("sku_id",)),
}


def load_batch(spark: SparkSession, root: str, overrides: dict[str, DataFrame] | None = None) -> tuple[BatchInputs, DataFrame, DataFrame]:
    """A batch's inputs from the folders of BATCH_TABLES below ``root``, with all rejects and counts.

    ``overrides`` gives tables instead of folders, which conform to the same schemas.
    """
    found = {}
    for name, (spec, required) in BATCH_TABLES.items():
        if overrides and name in overrides:
            rows = schemas.conform(overrides[name], spec)
            none = spark.createDataFrame([], REJECTS)
            found[name] = Loaded(rows, none, none.groupBy("source", "file").agg(*[F.count(F.lit(1)).alias(c) for c in ("rows", "empty", "rejected")]))
        else:
            found[name] = load_tsv(spark, f"{root}/{name}", spec, name, required)

    def all_of(side: str) -> DataFrame:
        parts = [getattr(x, side) for x in found.values()]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    lines = found["order_lines"].rows.withColumn("sale_ord_dt", F.to_date("sale_ord_tm"))
    inputs = BatchInputs(lines, sku_scan(found["sku_master"].rows), found["category_tree"].rows, found["attributes"].rows, found["brand_dict"].rows,
                         found["fourth_category"].rows)
    return inputs, all_of("rejects"), all_of("counts")
