"""Table-based logistic regression and its search, against Spark ML, numpy and each other."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexmill.operators import linear


def sample(seed, n=150, terms=6):
    """Rows of unit length whose label follows some of the terms, with noise; one row without terms."""
    rng = random.Random(seed)
    truth = [rng.uniform(-4, 4) for _ in range(terms)]
    features, labels, matrix = [], [], np.zeros((n, terms))
    for k in range(n):
        for t in rng.sample(range(terms), rng.randint(1, 4)):
            matrix[k, t] = rng.uniform(0.1, 1)
        matrix[k] /= np.linalg.norm(matrix[k])
        labels.append((k, int(rng.random() < 1 / (1 + math.exp(-matrix[k] @ truth - 0.3)))))
        features += [(k, f"t{t}", float(w)) for t, w in enumerate(matrix[k]) if w]
    labels.append((n, 1))
    return features, labels, np.vstack([matrix, np.zeros(terms)])


@pytest.fixture(scope="module")
def tables(spark):
    features, labels, matrix = sample(3)
    f = spark.createDataFrame(features, "id long, term string, weight double")
    y = spark.createDataFrame([(k, v, k % 3) for k, v in labels], "id long, label int, fold int")
    return f, y, matrix, np.array([v for _, v in labels])


@pytest.mark.parametrize("penalty,C", [("l2", 0.05), ("l1", 0.3)])
def test_coefficients_equal_spark_ml(spark, tables, penalty, C):
    f, y, matrix, labels = tables
    got = {r["term"]: r["w"] for r in linear.fit_logistic(f, y, penalty, C, 45, 1e-5).collect()}
    rows = spark.createDataFrame([(float(v), Vectors.dense(x)) for x, v in zip(matrix, labels)], ["label", "features"])
    model = LogisticRegression(maxIter=500, tol=1e-10, regParam=1 / (C * len(labels)), standardization=False,
                               elasticNetParam=1.0 if penalty == "l1" else 0.0).fit(rows)
    assert abs(got[""] - model.intercept) < 2e-3
    for k, c in enumerate(model.coefficients.toArray()):
        assert abs(got.get(f"t{k}", 0.0) - c) < 2e-3


def test_one_step_equals_numpy(tables):
    f, y, matrix, labels = tables
    data = linear.design(f, y)
    tasks = [linear.Task("l2", 2.0), linear.Task("l1", 5.0)]
    state = linear.step(data, linear.start_state(data, tasks), tasks, 0.0)
    got = {r["term"]: (r["w0"], r["w1"]) for r in state.collect()}
    x = np.hstack([matrix, np.ones((len(matrix), 1))])
    g, d, n = x.T @ (0.5 - labels), 0.25 * x.T @ x.sum(axis=1), len(labels)
    for k, name in enumerate([f"t{k}" for k in range(matrix.shape[1])] + [""]):
        s = [0 if name == "" else 1 / (C * n) for C in (2.0, 5.0)]
        assert abs(got[name][0] + g[k] / n / (d[k] / n + s[0])) < 1e-12
        assert abs(got[name][1] + np.sign(g[k]) * max(abs(g[k] / n) - s[1], 0) / (d[k] / n)) < 1e-12


def test_tasks_share_scans_without_touching_each_other(tables):
    """A point and fold learns the same alone and among others."""
    f, y, _, _ = tables
    data = linear.design(f, y, fold="fold")
    tasks = [linear.Task("l2", 1.0, 0, 0), linear.Task("l1", 0.5, 1, 2), linear.Task("l2", 0.1, 2, None)]
    together, _ = linear.run_steps(data, linear.start_state(data, tasks), tasks, 3, 0.0)
    for j, t in enumerate(tasks):
        alone, _ = linear.run_steps(data, linear.start_state(data, [t]), [t], 3, 0.0)
        a = {r["term"]: r[f"w{j}"] for r in together.collect()}
        b = {r["term"]: r["w0"] for r in alone.collect()}
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_a_step_is_one_exchange(tables):
    f, y, _, _ = tables
    data = linear.design(f, y)
    tasks = [linear.Task("l2", 1.0)]
    state = linear.start_state(data, tasks)
    plan = linear.gradients(data, state, tasks, ["v0"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(term" in plan


def test_halving_finds_the_winner_of_the_full_grid(spark, tables):
    f, y, _, _ = tables
    points = [{"penalty": p, "C": c, "max_iter": 14} for p in ("l1", "l2") for c in (0.001, 5.0)]
    weights, scores, rungs = linear.search(f, y, points, first_steps=2)
    _, full, one = linear.search(f, y, points, first_steps=14, halve=False, refit=False)
    every = {r["trial"]: r["accuracy"] for r in full.collect()}
    winner = next(r["trial"] for r in scores.collect() if r["best"])
    assert abs(every[winner] - max(every.values())) < 1e-9 and weights.count() > 1
    table = rungs.collect()
    assert [sum(r["rung"] == k for r in table) for k in range(3)] == [4, 2, 1]
    assert [r["steps"] for r in table if r["kept"]] == [2, 2, 6, 14] and one.count() == 4


def test_jobs_do_not_grow_with_the_points(spark, tables):
    f, y, _, _ = tables
    data = linear.design(f, y, fold="fold")
    tracker = spark.sparkContext.statusTracker()

    def jobs(points):
        group = f"points-{points}"
        spark.sparkContext.setJobGroup(group, group)
        tasks = [linear.Task("l2", 1.0 + p, p, k) for p in range(points) for k in range(3)]
        linear.run_steps(data, linear.start_state(data, tasks), tasks, 2, 0.0)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(5) == jobs(1)


def test_word_weights_and_edges(spark, tables):
    f, y, _, _ = tables
    weights = spark.createDataFrame([("", 9.0), ("a", 1.0), ("b", -2.0), ("c", 3.0), ("d", 3.0)], "term string, w double")
    assert [tuple(r) for r in linear.word_weights(weights, 2).collect()] == [
        ("c", 3.0, "positive"), ("d", 3.0, "positive"), ("b", -2.0, "negative"), ("a", 1.0, "negative")]
    assert linear.fit_logistic(f, y.where("id < 0")).collect() == []
    only = {r["term"]: r["w"] for r in linear.fit_logistic(f.where("id < 0"), y, max_iter=15).collect()}
    share = y.agg(F.avg("label")).first()[0]
    assert only.keys() == {""} and abs(only[""] - math.log(share / (1 - share))) < 1e-3
    with pytest.raises(ValueError):
        linear.fit_logistic(f, y, penalty="l3")
