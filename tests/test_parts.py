"""Rows packed by parts: what a pass over them shuffles, odd ids and the sums of a step."""

import math

from lexmill.operators import linear


def test_a_step_shuffles_terms_of_parts_and_no_entries(spark):
    rows = [(i, f"t{k}", 0.5 + k) for i in range(300) for k in range(4)]
    f = spark.createDataFrame(rows, "id long, term string, weight double")
    y = spark.createDataFrame([(i, i % 2) for i in range(300)], "id long, label int")
    data = linear.design(f, y, buckets=3)
    assert data.links.count() <= 3 * 5
    assert "terms" not in data.rows.columns and data.rows.count() == 300
    tasks = [linear.Task("l2", 1.0)]
    text = linear.gradients(data, linear.start_state(data, tasks), tasks, ["v0"])._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in text


def test_repeated_and_null_ids(spark):
    f = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, "b", 3.0), (None, "a", 9.0), (7, "z", 5.0)],
                              "id long, term string, weight double")
    y = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (4, 0)], "id long, label int")
    data = linear.design(f, y, buckets=2)
    tasks = [linear.Task("l2", 1.0)]
    got = {r["term"]: r["g0"] for r in linear.gradients(data, linear.start_state(data, tasks), tasks, ["v0"]).collect()}
    assert got == {"a": -2.0, "b": 1.5, "": 0.0}
    curve = {r["term"]: r["d"] for r in data.curvature.collect()}
    assert curve == {"a": 0.25 * 2 * 2 * 3, "b": 0.25 * 3 * 4, "": 0.25 * (3 + 3 + 4 + 1 + 1)}


def test_margins_of_repeated_ids_and_null_labels(spark):
    """As a sum over all entries of an id gives them."""
    f = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "b", 1.0)], "id long, term string, weight double")
    y = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, None)], "id long, label int")
    data = linear.design(f, y, buckets=2)
    state = data.curvature.selectExpr("term", "d", "case term when 'a' then 0.5 when '' then 0.25 end as v0", "0.0d as w0")
    got = {r["term"]: r["g0"] for r in linear.gradients(data, state, [linear.Task("l2", 1.0)], ["v0"]).collect()}
    p = 1 / (1 + math.exp(-1.5))
    assert got["b"] is None and abs(got["a"] - (2 * p - 1)) < 1e-12 and abs(got[""] - (2 * p - 1)) < 1e-12


def test_a_part_is_bounded_by_its_entries(spark, monkeypatch):
    """Long rows make more parts, and blocks follow the number of terms; sums stay those of one part."""
    from lexmill.operators import parts

    f = spark.createDataFrame([(i, f"t{(i * 7 + k) % 90}", 1.0 + k % 3) for i in range(40) for k in range(50)],
                              "id long, term string, weight double")
    y = spark.createDataFrame([(i, i % 2) for i in range(40)], "id long, label int")
    whole = {r["term"]: r["d"] for r in linear.design(f, y, buckets=1).curvature.collect()}
    monkeypatch.setattr(parts, "PART_ENTRIES", 100)
    monkeypatch.setattr(parts, "BLOCK_TERMS", 10)
    packed, n, blocks = parts.pack(f, y, "id", "label", None, 1)
    assert n == 20 and 8 <= blocks <= 10 and parts.rows_of(packed).count() == 40
    most = parts.rows_of(packed).groupBy("part").agg({"at": "count"}).agg({"count(at)": "max"}).first()[0]
    assert most <= 8
    again = {r["term"]: r["d"] for r in linear.design(f, y, buckets=1).curvature.collect()}
    assert again.keys() == whole.keys() and all(abs(again[t] - d) < 1e-9 * d for t, d in whole.items())
