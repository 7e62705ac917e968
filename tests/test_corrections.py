"""Cases that once gave wrong answers."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import metrics, models, relational, scoring, words
from lexmill.plans.registry import QUERIES
from lexmill.session import stage_bucketed
from lexmill.sources import versions


def test_repeated_label_ids_fail(spark):
    x = spark.createDataFrame([(1, "a"), (2, "b")], "id long, feature string")
    y = spark.createDataFrame([(1, 0), (2, 1), (2, 0)], "id long, label int")
    with pytest.raises(Exception, match="several labels for id 2"):
        relational.attach_labels(x, y).collect()
    last = relational.attach_labels(x, y.withColumn("o", F.col("label") * -1), order="o").orderBy("id").collect()
    assert [(r["id"], r["label"]) for r in last] == [(1, 0), (2, 0)]


def test_request_body_may_begin_with_white_space(spark):
    df = spark.createDataFrame([("\n{\"tweet\": \"hi\"}",), ("\t [1]",), ("x",)], "body string")
    rows = scoring.validate_requests(df).collect()
    assert [r["error"] for r in rows] == [None, "body is not JSON", "body is not JSON"]


def test_confusion_matrix_counts_every_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 1), (2, 2)], "truth int, prediction int")
    rows = {r["truth"]: r.asDict() for r in metrics.confusion_matrix(df, "truth", "prediction").collect()}
    assert sum(v for r in rows.values() for k, v in r.items() if k != "truth") == 4
    assert rows[2] == {"truth": 2, "pred_0": 0, "pred_1": 1, "pred_2": 1}


def test_rows_without_terms_are_trained_on_and_scored(spark):
    features = spark.createDataFrame([(1, "good", 1.0)], "id long, term string, weight double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id long, label int")
    _, scored = models.partial_fit(models.no_weights(spark), features, labels)
    assert {r["id"]: r["score"] for r in scored.collect()} == {1: 0.5, 2: 0.5}


def test_sgd_takes_a_step_for_each_batch_of_rows(spark):
    labels = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("label"))
    features = labels.select("id", F.lit("t").alias("term"), F.lit(1.0).alias("weight"))
    assert models.sgd_logistic(features, labels, batch_rows=10)[1].count() == 4


def test_lemmas_of_any_depth(spark):
    vocab = spark.createDataFrame([("bosss",), ("bosssss",), ("bo",), ("xs",)], "word string")
    lexicon = spark.createDataFrame([("bo",)], "word string")
    got = {r["word"]: r["new_word"] for r in words.lemma_table(vocab, lexicon).collect()}
    assert got == {"bosss": "bo", "bosssss": "bo", "bo": "bo"}


@pytest.mark.parametrize("name", ["class_quality_by_day", "latency_alerts", "error_rate_alerts", "stream_latency_alerts"])
def test_days_do_not_depend_on_the_time_zone(spark, folder, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.append(sorted(map(str, QUERIES[name](spark, folder).collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1]


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from lexmill import session

    class Context:
        master = "spark://host:7077"

    class Session:
        conf = spark.conf
        sparkContext = Context()

    monkeypatch.setattr(type(spark.conf), "get", lambda *a: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_lemmas_of_a_long_run(spark):
    """A junk word of 2,000 letters takes no longer than its place in the lexicon, and the table is a few jobs."""
    vocab = spark.createDataFrame([("s" * 2_000, 1), ("ab" + "s" * 2_000, 1), ("grass", 1), ("grasses", 1), ("wolves", 1),
                                   ("women", 1), ("men", 1)], "word string, n int")
    lexicon = spark.createDataFrame([("sss",), ("ab",), ("grass",), ("wolf",), ("woman",), ("s",)], "word string")
    spark.sparkContext.setJobGroup("lemmas", "lemmas")
    got = {r["word"]: r["new_word"] for r in words.lemma_table(vocab, lexicon).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("lemmas"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"s" * 2_000: "sss", "ab" + "s" * 2_000: "ab", "grass": "grass", "grasses": "grass", "wolves": "wolf",
                   "women": "woman"}
    assert jobs <= 12


def test_first_rows_without_sorting_texts(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, None, 5), (4, None, 4), (5, "b", 9)], "id long, t string, o long")
    out = relational.dedup_by_text(df, "t", F.col("o"), unique=True)
    assert sorted(r["id"] for r in out.collect()) == [2, 4, 5]
    by_id = relational.dedup_by_id(df, "o", F.col("id"), unique=True)
    assert by_id.count() == 5


def test_versions_are_whole(spark, tmp_path):
    folder = str(tmp_path / "model")
    a = spark.createDataFrame([("x", 1.0)], "term string, w double")
    with pytest.raises(ValueError):
        versions.load(spark, folder)
    versions.publish({"weights": a, "idf": a}, folder, 1)
    # A writer that stopped before its manifest.
    a.write.parquet(f"{folder}/tables/weights-2-stopped")
    assert versions.versions(spark, folder) == [1]
    with pytest.raises(ValueError):
        versions.publish({"weights": a}, folder, 1)
    versions.publish({"weights": a.withColumn("w", F.lit(2.0))}, folder, 2)
    assert versions.load(spark, folder)["weights"].first()["w"] == 2.0
    assert versions.load(spark, folder, 1)["idf"].first()["w"] == 1.0


def test_stored_layout_joins_without_an_exchange(spark):
    x = spark.createDataFrame([(k, f"t{k}") for k in range(100)], "id long, feature string")
    y = spark.createDataFrame([(k, k % 2) for k in range(0, 100, 2)], "id long, label int")
    x, y = stage_bucketed(x, "x", ["id"], 4), stage_bucketed(y, "y", ["id"], 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for out, n in ((relational.merge_on_id(x, y), 50), (relational.sync_labels(y, x), 50),
                       (relational.attach_labels(x.join(y.select("id"), "id", "left_semi"), y), 50)):
            assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
