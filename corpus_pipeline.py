"""The training-data pipeline over ``documents``; its stages are operators of ``lexmill.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.
Rows with a null or empty text pass the filters; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontaminate, jaccard, packing, substring
from lexmill.llm import toxicity as compression
from lexmill.llm.queries import TOXIC_SCORE, byte_bpe, held_out, table
from lexmill.session import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the rest goes."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(3, 1))
    return compression.score(docs, compression.train(docs, labels), name="_score").where(
        F.col("_score") < TOXIC_SCORE).drop("_score")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    groups = jaccard.near_duplicates(docs)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document holds too."""
    cut = substring.cut_spans(docs, substring.repeated_spans(docs))
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    marked = decontaminate.mark_leaks(docs, table(spark, sf_dir, "benchmark"), name="_leaks")
    return marked.where(F.size("_leaks") == 0).drop("_leaks")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, byte_bpe())).drop("rank")


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", ngram_jaccard_join), ("substring_dedup", substring_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("best_fit_packing", best_fit_packing)]

# Compression, hashes, tokens and packing are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
