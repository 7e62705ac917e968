"""The registered queries and the pipeline on the given tables, against SQL or brute force."""

import zlib

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import decontaminate
from lexmill.llm.queries import ORACLES, QUERIES
from test_ops import brute_components

COLUMNS = {
    "op1_": {"doc_id", "start", "length", "words", "kept_doc_ids"},
    "op2_": {"doc_id", "n_shingles", "component_id"},
    "op3_": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op4_": {"vec_id", "n_links", "component_id", "kept"},
    "op5_": {"doc_id", "held_out", "score", "predicted"},
    "op6_": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op7_": {"page_id", "host", "path", "rule", "verdict"},
    "op8_": {"doc_id", "held_out", "score", "predicted"},
    "op9_": {"doc_id", "item_id", "containment"},
    "op10_": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    "op11_": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op12_": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op13_": {"word", "n", "form", "root", "n_near", "form_n"},
}


def named(prefix):
    return next(q for q in QUERIES if q.startswith(prefix))


WITH_SQL = ["op7_", "op10_", "op12_", "op13_"]


@pytest.mark.parametrize("prefix", WITH_SQL)
def test_sql_counterpart(spark, folder, prefix):
    error, rows, _, _ = compare(spark, connect(folder), folder, named(prefix), QUERIES, ORACLES)
    assert error is None and (rows > 0 or prefix == "op12_")


@pytest.mark.parametrize("prefix", [p for p in COLUMNS if p not in WITH_SQL])
def test_whole_tables(spark, folder, prefix):
    out = QUERIES[named(prefix)](spark, folder)
    assert set(out.columns) == COLUMNS[prefix]
    rows = out.collect()
    table = "embeddings" if prefix == "op4_" else "documents"
    ids = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(
        "vec_id" if prefix == "op4_" else "doc_id").collect()}
    if prefix in ("op1_", "op9_"):
        assert {r["doc_id"] for r in rows} < ids
    else:
        assert {r[0] for r in rows} == ids
        assert len(rows) == len(ids) or prefix == "op3_"
    if prefix in ("op5_", "op8_"):
        modulus, remainder, threshold = (5, 0, 0.3) if prefix == "op5_" else (3, 1, 0.7)
        for r in rows:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)


def test_jaccard_query_equals_brute_force(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES[named("op2_")](spark, folder).collect()}
    assert got == brute_components(docs, 3, 90)


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    texts = {}
    for name, apply in corpus_pipeline.STAGES:
        after = apply(spark, before, folder).cache()
        if name != "best_fit_packing":
            assert after.columns == columns
        old = {r["doc_id"]: r["text"] for r in before.collect()}
        new = {r["doc_id"]: r["text"] for r in after.collect()} if name != "best_fit_packing" else None
        if name == "ngram_jaccard_join":
            want = brute_components(list(old.items()), 5, 80)
            assert new == {i: t for i, t in old.items() if want[i][1] == i}
        if name == "substring_dedup":
            assert new.keys() == old.keys() and all(len(new[i]) <= len(old[i]) for i in new)
        if name == "benchmark_decontamination":
            items = [decontaminate.shingles(decontaminate.words(r["text"])) for r in
                     spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            leaky = {i for i, t in old.items() for s in items
                     if len(s & decontaminate.shingles(decontaminate.words(t))) >= 0.8 * len(s)}
            assert new == {i: t for i, t in old.items() if i not in leaky}
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in after.select("doc_id").collect()} == set(old)
            assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
        before = after
        texts[name] = new
    assert len(texts["toxicity"]) < docs.count()
