"""Plans and skew: what has to hold when the data grows."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import metrics, monitor, relational, splits
from lexmill.plans.registry import QUERIES, cleaned
from lexmill.session import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NAMES = ["clean_base", "sync_labels", "attach_labels", "dedup_by_text", "tfidf", "vector_sequence", "mean_vector",
         "kde_words", "roc_curve", "ks_drift", "segment_words", "token_coverage", "prediction_shift", "word_index"]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark, folder):
    text = plan(cleaned(spark, folder).select("feature"))
    assert "ReadSchema: struct<text:string>" in text


def test_filters_reach_the_scan(spark, folder):
    from lexmill.sources.readers import read_table

    text = plan(read_table(spark, folder, "documents", "doc_id", "lang").where("lang = 'en'").select("doc_id"))
    assert "EqualTo(lang,en)" in text


def test_dedup_needs_no_window_and_survives_a_hot_key(spark):
    # A third of all rows has one id and one text.
    df = spark.range(90_000).select(
        F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t"))
    by_id = relational.dedup_by_id(df, "id", F.col("o"))
    assert "Window" not in plan(by_id)
    assert by_id.count() == 60_001 and by_id.where("id = -1").first()["o"] == 0
    by_text = relational.dedup_by_text(df, "t", F.col("o"))
    assert by_text.count() == 60_001 and by_text.where("t = 'hot'").first()["o"] == 0


def test_hot_score_and_value(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 30_000).alias("score"),
        (F.col("id") % 2).cast("int").alias("truth"))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="truth", numBins=0).evaluate(df)
    assert metrics.roc_auc(df, "truth", "score").first()[0] == pytest.approx(want, abs=1e-9)
    drift = monitor.ks_drift(df.where("truth = 0"), df.where("truth = 1"), "score").first()
    assert drift["n"] == drift["m"] == 15_000 and drift["statistic"] < 0.01


@pytest.mark.parametrize("name", ["split_stratified_exact", "split_tail", "word_index", "tfidf_vocabulary", "roc_curve"])
def test_result_does_not_depend_on_partitions(spark, folder, name):
    seen = []
    for n in ("4", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            seen.append(sorted(map(repr, QUERIES[name](spark, folder).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and seen[0]


def test_split_join_is_broadcast_by_size(spark):
    df = stage(spark.range(5000).select("id", (F.col("id") % 2).alias("label")))
    out = splits.split_stratified_exact(df, "id", "label", "0.1", "0.1")
    assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
