"""One query per operator of this folder, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.llm import bpe, cuckoo, decontaminate, entropy_secrets, histogram_sort, minhash, page_diff, pii, spelling, statements, substrings, toxicity, vector_codes, warc
from basketshift.llm.common import table, text_of


def op1_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row_no", "text_hash")


def op2_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), labels).drop("text")


def op4_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.find_items(table(spark, sf_dir, "documents", "doc_id", "text"), items).drop("row_no")


def op5_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")


def op6_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entropy_secrets.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_entropy")


def op7_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), "first").alias("kept"))


def op8_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_and_index(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (histogram_sort.shard(table(spark, sf_dir, "documents", "doc_id", "text"))
            .select("doc_id", "size", F.crc32(text_of().cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                    "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), with_text=False).drop("kept")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(vector_codes.book_hash(books)).alias("codebooks_sha256"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_cuckoo_dedup, op2_page_differencing, op3_toxicity_lexicon, op4_edit_decontamination, op5_bootstrapped_pii, op6_entropy_secrets,
        op7_super_minhash, op8_warc_merge, op9_histogram_shards, op10_bpe, op11_spelling_variants, op12_repeated_passages, op13_vector_codes)}


def all_statements() -> dict[str, str]:
    return {"op1_cuckoo_dedup": statements.EXACT_DEDUP, "op7_super_minhash": statements.NEAR_GROUPS, "op11_spelling_variants": spelling.statement(), "op12_repeated_passages": substrings.statement(),
            "op13_vector_codes": vector_codes.statement()}
