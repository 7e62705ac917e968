"""Sources, sinks, filters, joins, de-duplication and splits."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import filters, relational, splits
from lexmill.plans import flows
from lexmill.sources import readers, schemas, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def xy(spark):
    x = spark.createDataFrame([(1, "good day"), (2, ""), (3, None), (4, " "), (5, "bad")], "id long, feature string")
    y = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, 0), (6, 1)], "id long, label int")
    return x, y


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('"0","11","Mon","NO_QUERY","ann","a ""quoted"" text, with comma"\n'
                    '"4","12","Tue","NO_QUERY","bob","two\nlines"\n"4","13","Tue","n/a","cem","null"\n')
    df = readers.read_posts(spark, str(path), multi_line=True)
    assert rows(df, "polarity", "post_id", "text") == [
        (0, 11, 'a "quoted" text, with comma'), (4, 12, "two\nlines"), (4, 13, "null")]
    df = readers.read_posts(spark, str(path), na_strings=True, multi_line=True)
    assert df.where("post_id = 13").select("query", "text", "user").first() == (None, None, "cem")


def test_pairs_and_word_vectors(spark, tmp_path):
    csv = tmp_path / "x.csv"
    csv.write_text('id,feature\n1,"a, b"\n2,c\n')
    assert rows(readers.read_features(spark, str(csv))) == [(1, "a, b"), (2, "c")]
    lines = tmp_path / "vectors.txt"
    lines.write_text("good 1 0\nday 0 1\nbad 1 2 3\nodd 1 x\ngood 5 5\n")
    last = readers.read_word_vectors(spark, str(lines), 2)
    assert rows(last) == [("day", [0.0, 1.0]), ("good", [5.0, 5.0])]
    first = readers.read_word_vectors(spark, str(lines), 2, keep="first")
    assert rows(first) == [("day", [0.0, 1.0]), ("good", [1.0, 0.0])]
    with pytest.raises(ValueError):
        readers.read_word_vectors(spark, str(lines), 2, keep="any")


def test_guards(spark, xy):
    x, _ = xy
    assert schemas.require_columns(x, "id", "feature") is x
    with pytest.raises(ValueError, match="label"):
        schemas.require_columns(x, "label")
    with pytest.raises(ValueError):
        schemas.require_files(["a"])


def test_filters(spark, xy):
    x, y = xy
    assert rows(filters.keep_valid(x), "id") == [(1,), (5,)]
    assert rows(filters.drop_empty(x), "id") == [(1,), (4,), (5,)]
    assert rows(filters.split_valid(x)[1], "id") == [(2,), (3,), (4,)]
    assert rows(filters.rows_with_null(x), "id") == [(3,)]
    assert rows(filters.null_counts(x)) == [(0, 1)]
    from lexmill.functions.text import is_valid
    assert rows(filters.cleaning_report(x, y, is_valid(F.col("feature")))) == [(5, 2, 3, 2)]
    assert rows(relational.sync_labels(filters.keep_valid(x), y)) == [(1, 1), (5, 0)]


def test_attach(spark, xy):
    x, y = xy
    assert rows(relational.attach_labels(x, y), "id", "label") == [(1, 1), (2, 0), (3, 1), (4, 0), (5, 0)]
    extra = x.unionByName(spark.createDataFrame([(7, "no label")], x.schema))
    with pytest.raises(Exception, match="no label for id 7"):
        relational.attach_labels(extra, y).collect()
    repeated = spark.createDataFrame([(1, 0, 1), (1, 1, 2)], "id long, label int, o int")
    only = x.where("id = 1")
    assert rows(relational.attach_labels(only, repeated, order="o"), "id", "label") == [(1, 1)]
    # A label that is itself null is not a missing row.
    nulls = spark.createDataFrame([(1, None)], "id long, label int")
    assert rows(relational.attach_labels(only, nulls), "id", "label") == [(1, None)]
    assert rows(relational.missing_rows(extra, y), "id") == [(7,)]
    relational.require_complete(x, y)
    with pytest.raises(ValueError):
        relational.require_complete(extra, y)


def test_dedup(spark):
    df = spark.createDataFrame([(0, 1, "a"), (1, 1, "b"), (2, 2, "a"), (3, 3, "c"), (4, 4, "b")],
                               "o int, id long, t string")
    first = relational.dedup_by_id(df, "id", F.col("o"))
    assert rows(first, "id", "t") == [(1, "a"), (2, "a"), (3, "c"), (4, "b")]
    assert rows(relational.dedup_by_text(first, "t", F.col("o")), "id", "t") == [(1, "a"), (3, "c"), (4, "b")]


def test_quotas(spark):
    counts = spark.createDataFrame([(0, 501), (1, 499)], "label int, n long")
    assert rows(splits.class_quotas(counts, "label", "0.005", "0.07")) == [(0, 3, 35), (1, 2, 35)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_split(spark, partitions):
    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).cast("int").alias("label")).repartition(partitions)
    out = splits.split_stratified_exact(df, "id", "label", "0.1", "0.2")
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert counts == {(0, "test"): 200, (1, "test"): 100, (0, "val"): 400, (1, "val"): 200,
                      (0, "train"): 1400, (1, "train"): 700}
    digest = out.where("split = 'test'").agg(F.sum("id")).first()[0]
    assert digest == splits.split_stratified_exact(df.repartition(3), "id", "label", "0.1", "0.2").where(
        "split = 'test'").agg(F.sum("id")).first()[0]


def test_other_splits(spark):
    df = spark.range(1000).select("id")
    out = splits.split(df, "trainTest", test_size=0.3)
    assert out.count() == 1000 and 250 < out.where("split = 'test'").count() < 350
    assert splits.split(df, "trainValTest").groupBy("split").count().count() == 3
    folds = splits.expand_folds(splits.split(df, "crossValidation", folds=4), 4)
    assert folds.where("role = 'val'").groupBy("id").count().where("count <> 1").isEmpty()
    assert folds.count() == 4000
    tail = splits.split_tail(df, "id", 0.2)
    assert tail.where("split = 'val'").agg(F.min("id"), F.count("*")).first() == (800, 200)
    with pytest.raises(ValueError):
        splits.split(df, "other")


def test_flow_and_sinks(spark, tmp_path):
    words = ["good", "fine", "bad", "poor"]
    posts = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, 4).otherwise(0).alias("polarity"), F.col("id").alias("post_id"),
        F.concat_ws(" ", F.lit("@you"), F.when(F.col("id") % 2 == 0, F.lit(words[0])).otherwise(F.lit(words[2])),
                    F.concat(F.lit("w"), (F.col("id") % 50).cast("string")), F.col("id").cast("string")).alias("text"))
    x, y = flows.split_posts(posts.unionByName(posts), test_size="0.1", val_size="0.1")
    assert x.count() == y.count() == 600
    x, y = flows.clean_and_sync(x, y)
    writers.write_by_split(x, str(tmp_path / "x"))
    writers.write_by_split(y, str(tmp_path / "y"))
    again = spark.read.parquet(str(tmp_path / "x"))
    assert again.groupBy("split").count().where("split = 'test'").first()["count"] == 60
    vectors, model, report = flows.train_and_report(x, y, C=10.0, max_iter=30)
    assert report.where("class = 'accuracy'").first()["precision"] > 0.95
    # A fitted vectoriser keeps its results through a save and a load.
    from pyspark.ml import PipelineModel
    vectors.write().overwrite().save(str(tmp_path / "vectors"))
    sample = spark.createDataFrame([(["good", "w1"],)], "tokens array<string>")
    loaded = PipelineModel.load(str(tmp_path / "vectors"))
    assert loaded.transform(sample).first()["features"] == vectors.transform(sample).first()["features"]
    from lexmill.operators.metrics import flatten_report
    writers.write_metrics(flatten_report(report), str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).where("metric = 'test_accuracy'").count() == 1
    writers.write_predictions(spark.createDataFrame([(1, 0.5, 1)], "id long, score double, prediction int"),
                              str(tmp_path / "pred"))
    assert spark.read.json(str(tmp_path / "pred")).count() == 1
