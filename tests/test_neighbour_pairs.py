"""What the search for nearest neighbours writes before vectors meet."""

import numpy as np

from lexmill.operators import neighbours


def test_pairs_of_a_search_carry_no_vectors_until_they_meet(spark, monkeypatch):
    draw = np.random.default_rng(5).normal(size=(400, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(draw)], "id long, vec array<double>")
    written, stage = {}, neighbours.stage
    monkeypatch.setattr(neighbours, "stage", lambda d, name="stage": written.setdefault(name, d.columns) and stage(d, name))
    monkeypatch.setattr(neighbours, "SLICE", 7)
    got = {r[0]: r[1] for r in neighbours.nearest_neighbours(df, df, "id", "vec", block_rows=32).collect()}
    unit = draw / np.linalg.norm(draw, axis=1, keepdims=True)
    scores = unit @ unit.T - 9 * np.eye(len(unit))
    assert got == {i: int(k) for i, k in enumerate(scores.argmax(axis=1))}
    assert written["second"] == written["first"] == ["id", "cell", "ring"]
