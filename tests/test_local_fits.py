"""Fits that run each in one task, against the same fits in rounds over blocks."""

import random

import pytest

from lexmill.operators import lbfgs, local_fits


def tables(spark, seed=5):
    draw = random.Random(seed)
    truth = [draw.uniform(-3, 3) for _ in range(25)]
    f, y = [], []
    for i in range(160):
        x = {t: draw.uniform(0.1, 1) for t in draw.sample(range(25), draw.randint(0, 7))}
        f += [(i, f"t{t}", w) for t, w in x.items()]
        y.append((i, int(sum(truth[t] * w for t, w in x.items()) + draw.gauss(0, 1) > 0), i % 4 - 1))
    return (spark.createDataFrame(f, "id long, term string, weight double"), spark.createDataFrame(y, "id long, label int, fold int"))


def test_fits_of_a_search_take_no_job_a_round(spark, monkeypatch):
    f, y = tables(spark)
    fits = [lbfgs.Fit(p, c, 25, k) for p, c in (("l1", 0.01), ("l2", 0.003)) for k in (0, 2)] + [lbfgs.Fit("l2", 0.01, 3, 1)]
    data = lbfgs.spread(f, y, [0, 2, 1], fold="fold")
    held = [0, 2, 0, 2, 1]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("alone", "alone")
    got = local_fits.accuracies(data, fits, held)
    assert len(jobs.getJobIdsForGroup("alone")) < 12
    last = jobs.getJobInfo(max(jobs.getJobIdsForGroup("alone")))
    assert jobs.getStageInfo(max(last.stageIds)).numTasks == len(fits)
    monkeypatch.setattr(local_fits, "IN_MEMORY", 0)
    monkeypatch.setattr(local_fits, "AT_ONCE", 50)
    assert local_fits.accuracies(data, fits, held) == got
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    few = [lbfgs.Fit(t.penalty, t.strength, min(t.max_iter, 4), t.fold) for t in fits[::2]]
    alone = local_fits.accuracies(data, few, held[::2])
    monkeypatch.setattr(local_fits, "MOST_ENTRIES", 0)
    assert local_fits.accuracies(data, few, held[::2]) == alone


@pytest.mark.parametrize("penalty,strength", [("l2", 0.004), ("l1", 0.006)])
def test_weights_equal_spark_ml(spark, penalty, strength):
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(3)
    x = np.where(draw.random((200, 12)) < 0.4, draw.random((200, 12)), 0.0)
    x[0] = 0
    label = (x @ draw.uniform(-4, 4, 12) + draw.normal(size=200) > 0).astype(float)
    row, at = np.nonzero(x)
    sizes = np.bincount(row, minlength=200).astype("int32")
    full = np.flatnonzero(sizes)
    chunk = (full, (np.cumsum(sizes) - sizes)[full], sizes, label, 0, at.astype("int32"), x[row, at])
    fit = lbfgs.Fit(penalty, strength, 100)
    ones = int(label.sum())
    alone = local_fits._Alone([chunk], np.append(x.mean(axis=0), 0.0), np.append(x.std(axis=0, ddof=1), 1.0), fit, [200 - ones, ones], False)
    w = alone.solved(np.log(ones / (200 - ones))) * alone.inverse
    ml = spark.createDataFrame([(v, Vectors.dense(r)) for v, r in zip(label.tolist(), x.tolist())], ["label", "features"]).coalesce(1)
    model = LogisticRegression(maxIter=100, tol=1e-4, regParam=strength, standardization=False, elasticNetParam=float(penalty == "l1")).fit(ml)
    assert w[:-1] == pytest.approx(model.coefficients.toArray(), rel=1e-6, abs=1e-9)


def test_one_label_alone_and_no_terms(spark):
    f = spark.createDataFrame([], "id long, term string, weight double")
    y = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, -1)], "id long, label int, fold int")
    fits = [lbfgs.Fit("l2", 0.1)]
    data = lbfgs.spread(f, y, fold="fold")
    assert local_fits.accuracies(data, fits, [0]) == [1.0] and local_fits.accuracies(data, fits, [-1]) == [0.0]
