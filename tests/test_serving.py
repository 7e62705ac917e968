"""Requests, log, monitoring and the streaming twins."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.functions.text import feature_terms
from lexmill.operators import features, models, monitor, scoring
from lexmill.plans.registry import run_stream
from lexmill.streaming import streams


def test_requests(spark):
    bodies = ['{"tweet":"hi","true_label":" Positif "}', '{"tweet":"hi"}', '{"tweet":"hi","true_label":"neutre"}',
              "{", "[1]", '{"true_label":"negatif"}', '{"tweet":"boom","true_label":"negatif"}', None]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    out = scoring.validate_requests(df, with_truth=True, failed=F.col("tweet") == "boom").orderBy("i").collect()
    assert [r["error_code"] for r in out] == [None, 400, 400, 400, 400, 400, 500, 400]
    assert out[0]["true_label"] == "positif" and out[1]["error"] == "label is missing"
    assert out[3]["error"] == out[4]["error"] == "body is not JSON" and out[5]["error"] == "text is missing"
    plain = scoring.validate_requests(df).orderBy("i").collect()
    assert [r["error_code"] for r in plain] == [None, None, None, 400, 400, 400, None, 400]
    good, bad = scoring.route(scoring.validate_requests(df))
    assert (good.count(), bad.count()) == (4, 4)


def test_score_log_feedback(spark):
    df = spark.createDataFrame([("Good DAY!", 1), ("sad", 0)], "tweet string, n int")
    scorer = lambda d: d.withColumn("class_name", F.when(F.col("tweet") == "good day", "pos").otherwise("neg"))
    assert [r["predicted_sentiment"] for r in scoring.score_posts(df, scorer).orderBy("n").collect()] == ["negatif"] * 2
    cleaned = scoring.score_posts(df, scorer, clean=True).orderBy("n").collect()
    assert [r["predicted_sentiment"] for r in cleaned] == ["negatif", "positif"]
    log = scoring.prediction_log(df, "tweet", F.lit("positif"), F.lit(" Positif"), F.lit(12), "n").orderBy("n").first()
    assert (log["tweet_length"], log["correctness"], log["response_time_ms"]) == (3, "correct", 12.0)
    verdicts = spark.createDataFrame([("a", " OUI"), ("b", "Non"), ("c", "x")], "t string, v string")
    assert [r["outcome"] for r in scoring.feedback_rows(verdicts, "v").orderBy("t").collect()] == [
        "confirmed", "to_correct", "invalid"]
    assert [r["t"] for r in scoring.to_correct(verdicts, "v").collect()] == ["b"]
    test = spark.createDataFrame([(i, i % 2) for i in range(10)], "id long, truth int")
    answers = spark.createDataFrame([(i, 1 if i else None) for i in range(10)], "id long, prediction int")
    got = scoring.replay_accuracy(test, answers, "id", "truth", "prediction", 5).first()
    assert tuple(got) == (5, 4, 50.0)


def test_drift(spark):
    a = spark.range(1000).select(F.col("id").alias("v"))
    same = monitor.ks_drift(a, a, "v").first()
    assert same["statistic"] == 0.0 and same["p_value"] == 1.0 and same["drift"] is False
    moved = monitor.ks_drift(a, a.select((F.col("v") + 500).alias("v")), "v")
    row = moved.first()
    assert row["statistic"] == pytest.approx(0.5) and row["p_value"] < 1e-6 and row["drift"] is True
    assert monitor.should_retrain(moved).first()["retrain"] is True
    # Against brute force on two small samples with ties.
    xs, ys = [1, 2, 2, 3, 5, 8], [2, 3, 3, 4, 9]
    dist = max(abs(sum(x <= t for x in xs) / 6 - sum(y <= t for y in ys) / 5) for t in xs + ys)
    frame = lambda v: spark.createDataFrame([(float(x),) for x in v], "v double")
    assert monitor.ks_drift(frame(xs), frame(ys), "v").first()["statistic"] == pytest.approx(dist)


def test_shift_and_growth(spark):
    base = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    now = spark.createDataFrame([("a",), ("c",)], "c string")
    rows = {r["class"]: (r["base_share"], r["current_share"], r["abs_diff"]) for r in
            monitor.prediction_shift(base, now, "c").collect()}
    assert rows == {"a": (0.75, 0.5, 0.25), "b": (0.25, 0.0, 0.25), "c": (0.0, 0.5, 0.5)}
    known = spark.createDataFrame([(1,)], "id long")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (3, "y"), (4, "w")], "id long, t string")
    got = sorted(tuple(r) for r in monitor.incremental_labels(known, new, "id", "t").collect())
    assert got == [(2, "y"), (4, "w")]


@pytest.fixture(scope="module")
def event_files(spark, folder, tmp_path_factory):
    """Four files in time order; a fifth with one row three days late comes last."""
    path = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(f"{folder}/events.parquet")
    marked = events.withColumn("q", F.ntile(4).over(Window.orderBy("ts")))
    for k in range(1, 5):
        marked.where(F.col("q") == k).drop("q").coalesce(1).write.parquet(str(path / "in" / f"part{k}"))
    late = events.agg(F.max("ts").alias("m")).select(
        F.lit(-1).cast("long").alias("event_id"), (F.col("m") - F.expr("interval 3 days")).alias("ts"),
        F.lit(0).cast("long").alias("user_id"), F.lit("error").alias("event_type"), F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"))
    return path, events, late


def test_stream_equals_batch_with_late_row_and_restart(spark, event_files):
    path, events, late = event_files
    source, out, log = str(path / "in" / "*"), str(path / "out"), str(path / "log")

    def run():
        stream = streams.read_files(spark, source, streams.EVENT, files_per_trigger=1)
        alerts = monitor.latency_alerts(streams.with_event_time(stream), "ts", "value", 300.0)
        streams.write_append(alerts, out, log).awaitTermination()
        return {(r["window_start"], r["n"], round(r["mean_ms"], 6)) for r in spark.read.parquet(out).collect()}

    first = run()
    batch = monitor.latency_alerts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", 300.0)
    last = events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    want = {(r["window_start"], r["n"], round(r["mean_ms"], 6)) for r in batch.collect() if r["window_end"] <= last}
    assert first == want and len(first) > 20
    late.coalesce(1).write.parquet(str(path / "in" / "part5"))
    # The late row is dropped, and a restart from the checkpoint repeats nothing.
    assert run() == want
    assert spark.read.parquet(out).count() == len(want)


def test_stream_routing(spark, tmp_path):
    rows = spark.createDataFrame([(1, '{"tweet":"a"}'), (2, "no")], "i int, body string")
    rows.write.parquet(str(tmp_path / "in"))
    checked = scoring.validate_requests(streams.read_files(spark, str(tmp_path / "in"), rows.schema))
    sink = streams.route_to(str(tmp_path / "good"), str(tmp_path / "bad"))
    streams.write_batches(checked, sink, str(tmp_path / "log")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    sink(scoring.validate_requests(rows), 0)  # a repeated batch replaces its own folder
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert spark.read.parquet(str(tmp_path / "bad")).first()["error_code"] == 400


def test_stream_scoring_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"{'good' if i % 2 else 'dull'} w{i % 5}") for i in range(60)], "id long, tweet string")
    rows = rows.withColumn("label", (F.col("id") % 2).cast("int"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    ready = rows.withColumn("tokens", feature_terms(F.col("tweet")))
    vectors = models.fit_text_vectors(ready, max_features=32)
    model = models.logistic(60, max_iter=10).fit(vectors.transform(ready))

    def scorer(df):
        out = model.transform(vectors.transform(df.withColumn("tokens", feature_terms(F.col("tweet")))))
        return out.select("id", F.when(F.col("prediction") == 1, "pos").otherwise("neg").alias("class_name"))

    stream = streams.read_files(spark, str(tmp_path / "in"), rows.schema)
    got = run_stream(scoring.score_posts(stream, scorer), "scores")
    want = scoring.score_posts(rows, scorer)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("predicted_sentiment = 'positif'").count() == 30


def test_stream_training(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"{'good' if i % 2 else 'dull'}", i % 2) for i in range(80)],
                                 "id long, text string, label int")
    for k in range(2):
        rows.where((F.col("id") < 40) == F.lit(k == 0)).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
    idf = features.fit_idf(rows, feature_terms(F.col("text")))
    featurize = lambda b: features.tfidf(b, "id", feature_terms(F.col("text")), idf)
    sink = streams.fit_sink(str(tmp_path / "model"), featurize, F.col("label"))
    stream = streams.read_files(spark, str(tmp_path / "in" / "*"), rows.schema, files_per_trigger=1)
    streams.write_batches(stream, sink, str(tmp_path / "log")).awaitTermination()
    table = {r["term"]: r["w"] for r in streams.current_weights(spark, str(tmp_path / "model")).collect()}
    assert table["good"] > 0 > table["dull"]
    assert spark.read.parquet(str(tmp_path / "model")).select("version").distinct().count() == 2


def test_stream_new_labels_and_counts(spark, tmp_path):
    now = dt.datetime(2024, 1, 1, 12)
    rows = spark.createDataFrame([(1, "a", now), (2, "b", now), (3, "b", now), (4, "c", now)], "id long, t string, ts timestamp")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([(4,)], "id long")
    stream = streams.read_files(spark, str(tmp_path / "in"), rows.schema)
    got = run_stream(streams.new_labels(stream, known, "id", "t", "ts"), "labels").collect()
    assert sorted(r["t"] for r in got) == ["a", "b"]
    counts = streams.value_counts_by_window(rows, "ts", "t")
    assert sorted((r["value"], r["n"]) for r in counts.collect()) == [("a", 1), ("b", 2), ("c", 1)]
