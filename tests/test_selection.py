"""Exact quantiles and exact nearest neighbours against numpy."""

import math
import random

import numpy as np
import pytest

from lexmill.operators import neighbours, quantiles


def samples():
    rng = random.Random(2)
    return {"even": [rng.random() for _ in range(3_000)], "one value": [7.0] * 500,
            "heavy end": [1.0] * 2_000 + [rng.random() for _ in range(700)],
            "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(1_500)],
            "few": [3.0, 1.0], "single": [5.0], "two values": [0.0] * 999 + [1.0] * 1_001,
            "ints": [float(rng.randint(0, 40)) for _ in range(2_500)]}


@pytest.mark.parametrize("limit", [10, 400, 100_000])
def test_quantiles_equal_numpy(spark, limit):
    groups = samples()
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None), ("nothing", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    got = {(r["g"], r["share"]): r["value"] for r in quantiles.exact_quantiles(df, "v", shares, ["g"], limit).collect()}
    assert {g for g, _ in got} == set(groups)
    for (g, s), value in got.items():
        want = float(np.quantile(groups[g], s))
        assert math.isclose(value, want, rel_tol=1e-12, abs_tol=1e-300)


def test_quantiles_without_groups(spark):
    values = list(range(5_000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r["share"]: r["value"] for r in quantiles.exact_quantiles(df, "v", [0.5, 0.999], limit=50).collect()}
    assert got == {0.5: 2499.5, 0.999: pytest.approx(4994.001)}
    assert quantiles.exact_quantiles(df.where("v < 0"), "v", [0.5]).collect() == []


def clustered(seed, n, dim=16, centres=40, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))


def brute(ids, m):
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -np.inf)
    return {int(i): (int(ids[s[k].argmax()]), s[k].max()) for k, i in enumerate(ids)}


def vectors(spark, ids, m):
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, m)], "id long, vec array<double>")


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_neighbours_equal_brute_force(spark, spread):
    m = clustered(4, 900, spread=spread)
    m[10], m[11], m[12], m[13] = m[9], m[9] * 3, 0, 0
    ids = np.arange(900) * 3
    df = vectors(spark, ids, m)
    got = {r["id"]: (r["neighbour"], r["similarity"]) for r in neighbours.nearest_neighbours(
        df, df, "id", "vec", block_rows=40, pivots=20).collect()}
    want = brute(ids, m)
    assert got.keys() == want.keys()
    for i, (other, s) in want.items():
        assert abs(got[i][1] - s) < 1e-8
        assert got[i][0] == other or abs(s - got[i][1]) < 1e-8 and got[i][0] < other


def test_most_products_are_spared_on_clustered_rows(spark):
    m = clustered(5, 4_000, spread=0.02)
    df = vectors(spark, np.arange(4_000), m)
    found, work = neighbours.neighbour_search(df, df, "id", "vec", block_rows=64, pivots=64)
    assert found.count() == 4_000
    assert sum(r["products"] for r in work.collect()) < 4_000 * 4_000 / 10


def test_neighbour_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id long, vec array<double>")
    got = {r["id"]: (r["neighbour"], r["similarity"]) for r in neighbours.nearest_neighbours(df, df, "id", "vec").collect()}
    assert got == {1: (3, 0.0), 3: (1, 0.0)}
    one = df.where("id = 1")
    assert neighbours.nearest_neighbours(one, one, "id", "vec").collect() == []
    none = df.where("id = 9")
    assert neighbours.nearest_neighbours(none, none, "id", "vec").collect() == []
    assert neighbours.nearest_neighbours(df, df, "id", "vec", min_similarity=0.5).collect() == []
