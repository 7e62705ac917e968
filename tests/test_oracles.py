"""Every query with a SQL counterpart gives the same rows; the others give rows."""

import pytest
from compare import compare, connect

from lexmill.plans.oracles import ORACLES
from lexmill.plans.registry import QUERIES

SLOW = {"train_logistic", "batch_score", "grid_search", "grid_search_validation", "random_search", "cv_scores",
        "train_mlp", "sgd_logistic", "word_weights", "halving_search"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, folder, name):
    error, rows, _, _ = compare(spark, con, folder, name, QUERIES, ORACLES)
    assert error is None
    assert rows > 0 or name in ("quality_gate",)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["label", "term", "weight"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
