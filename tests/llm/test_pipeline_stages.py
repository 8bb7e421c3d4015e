"""The pipeline, its registration, and every query against brute force on the smallest tables."""

from __future__ import annotations

import re
import sys
import zlib

import corpus_pipeline
from basketshift.llm import decontaminate, queries, toxicity
from tests.llm.test_copies import brute_groups, lower

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(queries.all_queries()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.all_queries() if re.match(r"op\d+_", n)) == list(range(1, 14))


def test_entry_works_without_the_folder(monkeypatch):
    import importlib.util

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if "llm" in name or "corpus" in name else real(name, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    import __spark_entry__ as entry

    assert entry.queries() and not any(n.startswith("op") for n in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)


def test_stages_keep_what_brute_force_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, columns = docs.collect(), docs.columns
    for name, step in corpus_pipeline.STAGES:
        got = step(spark, docs, SF)
        if name == "bpe":
            out = got.collect()
            assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in rows) and all(r.n_tokens == len(r.ids) for r in out)
            return
        assert got.columns == columns
        docs = spark.createDataFrame(got.collect(), docs.schema)
        left = {(r.doc_id, r.text) for r in docs.collect()}
        if name == "toxicity":
            lexicon = toxicity.fit(spark.createDataFrame(rows, docs.schema), spark.read.parquet(f"{SF}/labels.parquet"))
            want = {(r.doc_id, r.text) for r in rows if toxicity.score(lexicon, r.text) < 0.5}
        elif name == "exact_dedup":
            last = {}
            for r in rows:
                last[lower(r.text)] = max(last.get(lower(r.text), -1), r.doc_id)
            want = {(r.doc_id, r.text) for r in rows if last[lower(r.text)] == r.doc_id}
        elif name == "near_dedup":
            kept = {i for i, _, c in brute_groups([(r.doc_id, r.text, "") for r in rows], 5) if i == c}
            want = {(r.doc_id, r.text) for r in rows if r.doc_id in kept}
        else:
            items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            exact = [r for r in rows if any(f" {' '.join(i)} " in f" {' '.join(decontaminate.words_of(r.text))} " for i in items)]
            assert exact and not {(r.doc_id, r.text) for r in exact} & left
            want = left
        assert left == want, name
        rows = docs.collect()


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_every_query_covers_its_table(spark):
    docs, pages, vectors = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages", "embeddings"))
    for name, query in queries.all_queries().items():
        df = query(spark, SF)
        if name.startswith("op4"):
            assert df.count() and set(df.columns) >= {"doc_id", "item_id"}
        elif name.startswith("op11"):
            assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and df.count()
        else:
            table, key = next((t, k) for t, k in ((pages, "page_id"), (vectors, "vec_id"), (docs, "doc_id")) if k in df.columns)
            assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in table.select(key).collect()), name


def test_contract_values(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    shards = queries.op9_histogram_shards(spark, SF).collect()
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in shards)
    assert {r.law for r in shards} == {"bytes"} and all(r.grown_shard is None for r in shards)
    near = queries.op7_super_minhash(spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in near) == sorted(brute_groups([(i, t, "") for i, t in texts.items()], 2))
    assert all(r.kept == (r.doc_id == r.component_id) for r in near)


NAMES = ("_folding", "score", "predicted", "held_out", "n_hits", "_keep_key", "_keep_hash", "_keep_number", "row_no", "text_hash", "a.b", "_boxed", "size")


def test_stages_keep_columns_of_any_name_and_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and an empty table through every stage, beside columns with the operators' names."""
    from tests.llm.cases import ROWS

    rows = [(i, t, *[f"{n} {k}" for n in NAMES]) for k, (i, t, _) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in NAMES))
    whole = {tuple(r) for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        empty = step(spark, docs.where("false"), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
        got = step(spark, docs, SF)
        left = [tuple(r) for r in got.collect()]
        assert got.columns == docs.columns and left and set(left) <= whole, name
        if name in ("toxicity", "decontamination"):
            assert len(left) == len(rows), name
        else:
            assert {lower(r[1]) for r in left} == {lower(r[1]) for r in rows}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)
