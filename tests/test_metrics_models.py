import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lexmill.functions.labels import threshold_class
from lexmill.operators import metrics, models
from lexmill.operators.features import fit_idf, tfidf
from lexmill.operators.splits import assign_folds


@pytest.fixture(scope="module")
def scored(spark):
    truth = [1, 1, 1, 0, 0, 0, 0, 1]
    score = [.9, .8, .4, .5, .3, .2, .6, .6]
    df = spark.createDataFrame(list(zip(truth, score)), "truth int, score double")
    return df.withColumn("prediction", threshold_class(F.col("score")))


def one(df):
    return tuple(None if v is None else round(v, 6) for v in df.first())


def test_point_measures(scored):
    cm = {r["truth"]: (r["pred_0"], r["pred_1"]) for r in
          metrics.confusion_matrix(scored, "truth", "prediction").collect()}
    assert cm == {0: (2, 2), 1: (1, 3)}
    assert one(metrics.accuracy(scored, "truth", "prediction")) == (0.625, 62.5)
    assert one(metrics.precision_recall_f1(scored, "truth", "prediction")) == (0.6, 0.75, 0.666667)


def test_report(spark, scored):
    rows = {r["class"]: tuple(round(r[c], 6) for c in ("precision", "recall", "f1", "support"))
            for r in metrics.classification_report(scored, "truth", "prediction").collect()}
    assert rows == {"1": (0.6, 0.75, 0.666667, 4), "0": (0.666667, 0.5, 0.571429, 4),
                    "accuracy": (0.625, 0.625, 0.625, 8), "macro avg": (0.633333, 0.625, 0.619048, 8),
                    "weighted avg": (0.633333, 0.625, 0.619048, 8)}
    never = spark.createDataFrame([(0, 0), (1, 0)], "truth int, prediction int")
    row = metrics.classification_report(never, "truth", "prediction").where("class = '1'").first()
    assert (row["precision"], row["recall"], row["f1"], row["support"]) == (0.0, 0.0, 0.0, 1)
    flat = metrics.flatten_report(metrics.classification_report(scored, "truth", "prediction"))
    names = {r["metric"]: r["value"] for r in flat.collect()}
    assert names["test_1_recall"] == 0.75 and names["test_accuracy"] == 0.625 and len(names) == 17


def test_curves(spark, scored):
    assert one(metrics.roc_auc(scored, "truth", "score")) == (0.84375,)
    assert one(metrics.average_precision(scored, "truth", "score")) == (0.854167,)
    tied = spark.createDataFrame(list(zip([1, 0, 1, 0, 1, 0], [.9, .8, .7, .6, .6, .2])), "truth int, score double")
    assert one(metrics.average_precision(tied, "truth", "score")) == (0.755556,)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="truth", numBins=0)
    assert one(metrics.roc_auc(tied, "truth", "score"))[0] == round(evaluator.evaluate(tied), 6)
    # A monotone map of the score changes nothing.
    cubed = tied.withColumn("score", F.pow("score", 3))
    assert one(metrics.roc_auc(cubed, "truth", "score")) == one(metrics.roc_auc(tied, "truth", "score"))
    single = scored.where("truth = 1")
    assert one(metrics.roc_auc(single, "truth", "score")) == (None,)
    points = metrics.roc_curve(scored, "truth", "score").collect()
    assert (None, 0.0, 0.0) in [tuple(p) for p in points] and max(p["tpr"] for p in points) == 1.0
    assert (None, 1.0, 0.0) in [tuple(p) for p in metrics.pr_curve(scored, "truth", "score").collect()]


def test_selection(scored):
    got = {r["metric"]: round(r["value"], 6) for r in
           metrics.evaluate(scored, "truth", "prediction", "score", ("f1", "roc_auc")).collect()}
    assert got == {"f1": 0.666667, "roc_auc": 0.84375}
    with pytest.raises(ValueError, match="other"):
        metrics.evaluate(scored, "truth", "prediction", metrics=("other",))


def test_default_on_failure(spark):
    df = spark.createDataFrame([(1, 0.7), (2, None)], "id long, score double")
    rows = metrics.score_with_default(df, "score").orderBy("id").collect()
    assert [(r["score"], r["failed"], r["prediction"]) for r in rows] == [(0.7, False, 1), (0.0, True, 0)]


@pytest.fixture(scope="module")
def learnable(spark):
    """Texts whose label is whether they hold the word good."""
    df = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("label"))
    return df.withColumn("tokens", F.array(
        F.when(F.col("label") == 1, "good").otherwise("dull"), F.concat(F.lit("w"), (F.col("id") % 37).cast("string")),
        F.lit("the")))


def test_incremental_training_learns(spark, learnable):
    rows = tfidf(learnable, "id", F.col("tokens"), fit_idf(learnable, F.col("tokens")))
    weights, losses = models.sgd_logistic(rows, learnable.select("id", "label"), batch_rows=100, rate=4.0)
    loss = [r["loss"] for r in losses.orderBy("step").collect()]
    assert loss[0] == pytest.approx(0.693147, abs=1e-5) and loss[-1] < loss[0] - 0.1
    table = {r["term"]: r["w"] for r in weights.collect()}
    assert table["good"] > 0 > table["dull"]
    again, _ = models.sgd_logistic(rows.repartition(3), learnable.select("id", "label"), batch_rows=100, rate=4.0)
    assert {r["term"]: round(r["w"], 9) for r in again.collect()} == {t: round(w, 9) for t, w in table.items()}


def test_logistic_search_and_weights(spark, learnable):
    vectors = models.fit_text_vectors(learnable, max_features=64)
    rows = assign_folds(vectors.transform(learnable), "id", 2).select("id", "label", "fold", "features").coalesce(1).cache()
    points = models.grid_points({"C": [0.01, 10.0], "max_iter": [10]})
    assert len(points) == 2 and points[0]["penalty"] == "l2"
    model, table = models.search(rows, points, fold="fold")
    assert table.agg(F.max("accuracy")).first()[0] == 1.0
    words = {(r["word"], r["side"]) for r in models.word_weights(vectors, model, spark, 1).collect()}
    assert words == {("good", "positive"), ("dull", "negative")}
    _, table = models.search(rows, models.random_points(2), val=rows)
    assert table.count() == 2
    assert models.random_points(3) == models.random_points(3)
    assert all(0.1 <= p["C"] <= 10 and 100 <= p["max_iter"] <= 1000 for p in models.random_points(20))
    assert models.cross_validated_scores(rows, 2, max_iter=10).count() == 2
    with pytest.raises(ValueError):
        models.search(rows, points)
    with pytest.raises(ValueError):
        models.logistic(1, penalty="elastic")


def test_dense_classifier(spark):
    from pyspark.ml.functions import array_to_vector

    df = spark.range(200).select((F.col("id") % 2).cast("int").alias("label"), array_to_vector(F.array(
        (F.col("id") % 2).cast("double"), (F.col("id") % 7) / 7.0)).alias("features"))
    model = models.dense_classifier(2, hidden=4, max_iter=30).fit(df)
    hit = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert hit == 1.0


def test_decisions(spark, tmp_path):
    table = spark.createDataFrame([("a", "accuracy", 0.71), ("b", "accuracy", 0.69)], "model string, metric string, value double")
    assert [r["model"] for r in models.quality_gate(table, minimum=0.7).collect()] == ["a"]
    registry = spark.createDataFrame([("a", 1, 0.7), ("b", 2, 0.8), ("a", 3, 0.75)], "model string, version int, value double")
    assert tuple(models.best_model(registry, 0.8).first()) == ("b", 2, 0.8, False)
    assert models.best_model(registry, 0.81).first()["newcomer_is_better"] is True
    rules = models.rules_table(spark)
    measured = spark.createDataFrame([("validation", "accuracy", 0.85), ("test", "f1", 0.79), ("drift", "ks_p_value", 0.2),
                                      ("serving", "latency_ms", 300.0)], "stage string, metric string, value double")
    got = {r["stage"]: r["passed"] for r in models.promotion(measured, rules).collect()}
    assert got == {"validation": True, "test": False, "drift": True, "serving": False, "real": False}
    records = models.run_records(spark.createDataFrame([("accuracy", 0.5)], "metric string, value double"), "r1", "m", "val")
    models.append_runs(records, str(tmp_path / "runs"))
    models.append_runs(records, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2
